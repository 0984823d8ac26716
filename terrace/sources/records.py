"""Multi-line delimited files read by many tasks.

A line break inside quotes belongs to its field, so whether a line begins a record
follows from all text before it. Every line is reduced to what it makes of that: the
quotes it leaves open after a closed and after an open start. These two bits compose,
first along the lines of each file block, then along the blocks of each file, one row a
block. No file and no block waits for another one's text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import stored


def opens_quote(line: Column, sep: str, inside: bool) -> Column:
    """Whether ``line`` ends within an open quote, if it starts inside one or at the start of a field.

    A quote opens only as a field's first character and is closed by the next one that
    is not doubled; what follows up to the separator is plain text.
    """
    sep = re.sub(r"([^\w\s])", r"\\\1", sep)
    body = '[^"]*+(?:""[^"]*+)*+'
    rest = f"(?:(?!{sep}).)*+{sep}"
    tail = f'(?:"{body}"{rest}|(?!"){rest})*+"{body}'
    pattern = rf'(?s)^{body}(?:"{rest}{tail})?+\z' if inside else rf"(?s)^{tail}\z"
    return F.when(F.contains(line, F.lit('"')), line.rlike(pattern)).otherwise(F.lit(inside))


def composed(after: tuple[Column, Column], window: Window) -> Column:
    """What all rows of ``window`` up to this one make of a closed or an open start.

    ``after`` holds whether quotes are open after a row, from a closed and from an open
    start. A row with both equal forgets what came before; one with both exchanged
    flips it; other rows keep it. Returns the struct (fixed, flips): the last value
    that forgets, or null, and whether an odd number of flips follows it.
    """
    closed, opened = after
    flips = F.sum(F.when(closed & ~opened, 1).otherwise(0)).over(window)
    forgets = F.when(closed == opened, F.struct(closed.alias("fixed"), flips.alias("flips")))
    last = F.last(forgets, ignorenulls=True).over(window)
    odd = F.pmod(flips - F.coalesce(last["flips"], F.lit(0)), F.lit(2)) == 1
    return F.struct(last["fixed"].alias("fixed"), odd.alias("flips"))


def applied(made: Column, start: Column) -> Column:
    return F.coalesce(made["fixed"], start) != F.coalesce(made["flips"], F.lit(False))


def text_records(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """One row (``record``, ``unclosed``) per record of the files at ``path``, line breaks inside quotes kept.

    Lines are exchanged once, by file block, and written to the shared folder; lines of
    records that span several are exchanged once more, by record. A record may span any
    number of blocks. An unclosed quote runs to the end of its file, without the last line
    break. Empty lines between records are no records. A carriage return before a line
    feed goes with it, so both kinds of line breaks give ``\\n`` inside quotes.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.regexp_replace("value", r"\r\z", "").alias("value"),
    )
    along = Window.partitionBy("file", "block").orderBy("line")
    made = composed((opens_quote(F.col("value"), sep, False), opens_quote(F.col("value"), sep, True)), along)
    lines = lines.withColumn("made", made)
    lines = stored(lines.withColumn("before", F.lag("made").over(along)), "text-lines")

    # One row a block from here on to the joins.
    shut, open_ = F.lit(False), F.lit(True)
    blocks = lines.groupBy("file", "block").agg(F.max_by("made", "line").alias("made"))
    over = Window.partitionBy("file").orderBy("block")
    blocks = blocks.withColumn("made", composed((applied(F.col("made"), shut), applied(F.col("made"), open_)), over))
    start = applied(F.lag("made").over(over), shut)
    blocks = blocks.select("file", "block", F.coalesce(start, shut).alias("start"))
    lines = lines.join(blocks, ["file", "block"]).select(
        "file", "block", "line", "value",
        F.coalesce(applied(F.col("before"), F.col("start")), F.col("start")).alias("within"),
        applied(F.col("made"), F.col("start")).alias("goes_on"),
    )

    # A record of several lines is named by the line that begins it, maybe blocks before.
    parts = lines.filter("within OR goes_on")
    begun = F.when(~F.col("within"), F.struct("block", "line"))
    heads = parts.groupBy("file", "block").agg(F.max(begun).alias("head"))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("file", "block", F.last("head", ignorenulls=True).over(earlier).alias("carried"))
    own = F.last(begun, ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("head", own).join(heads, ["file", "block"])
    parts = parts.withColumn("head", F.coalesce("head", "carried"))
    pieces = F.array_sort(F.collect_list(F.struct("block", "line", "value")))
    ends = F.max_by("goes_on", F.struct("block", "line"))
    joined = parts.groupBy("file", "head").agg(F.array_join(pieces["value"], "\n").alias("value"), ends.alias("goes_on"))
    records = lines.filter("NOT within AND NOT goes_on").select("value", "goes_on").union(joined.select("value", "goes_on"))
    return records.select(F.col("value").alias("record"), F.col("goes_on").alias("unclosed")).filter("record <> ''")


def read_records(spark: SparkSession, path: str, columns: Iterable[str], sep: str = "\t") -> DataFrame:
    """The rows ``read_delimited(multiline=True)`` gives, with files split over tasks; runs a first job at once.

    Where a file with a separator of several characters ends without a line break, the
    parser doubles a quote that stands last in it; here it stays single.
    """
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    fields = F.from_csv("record", schema, {"sep": sep, "nullValue": "", "escape": '"', "multiLine": "true"})
    records = text_records(spark, path, sep)
    # A last separator, which adds a field beyond the columns at most, keeps the parser from that doubling.
    ended = F.when(F.col("unclosed"), F.col("record")).otherwise(F.concat("record", F.lit(sep)))
    return records.select(ended.alias("record")).select(fields.alias("row")).select("row.*")
