"""Benchmark decontamination: a broadcast set of test n-grams, verified window by window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, ascii_lower, saved

BROADCAST_WINDOWS = 100_000
PASS_WINDOWS = 1 << 21


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, n: int, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """Distinct (item, window, len, hash): all ``n``-word windows of an item, or the whole of a shorter one."""
    items = benchmark.select(F.col(item_column).alias("item"), words_of(F.col(text_column)).alias("words"))
    items = items.where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(n))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("len") + 1)
    windows = items.withColumn("len", length).select(
        "item", "len", F.explode(F.transform(starts, lambda i: F.slice("words", i, F.col("len")))).alias("window")
    )
    return windows.select("item", "len", F.array_join("window", " ").alias("window"), F.xxhash64("window").alias("hash")).distinct()


def places(value: Column, bits: int) -> list[Column]:
    """The bits of a hash set that stand for ``value``: three overlapping parts of the hash."""
    return [F.pmod(F.shiftrightunsigned(value, part), F.lit(1 << bits)) for part in (0, 20, 40)]


def set_bits(windows: int, least: int = 20, most: int = 24) -> int:
    """Eight bits a window or more, a power of two from ``2**least`` to ``2**most``: at most about 3 % of other windows pass."""
    return min(max((8 * max(windows, 1) - 1).bit_length(), least), most)


def hash_set(windows: DataFrame, bits: int) -> list[int]:
    """The hashes as a bitmap of ``2**bits`` bits in 64-bit words."""
    spots = windows.select(F.explode(F.array(*places(F.col("hash"), bits))).alias("spot"))
    bit = F.expr("shiftleft(1L, cast(spot & 63 as int))")
    words = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = {r["word"]: r["bits"] for r in words.collect()}  # at most 2**(bits - 6) rows
    return [found.get(i, 0) for i in range(1 << max(bits - 6, 0))]


def in_set(bitmap: Column, bits: int, value: Column) -> Column:
    """Whether all places of ``value`` are set; the first one that is not ends the test."""

    def set_at(spot: Column) -> Column:
        word = F.element_at(bitmap, (F.shiftright(spot, 6) + 1).cast("int"))
        return F.getbit(word, spot.bitwiseAND(F.lit(63)).cast("int")) == 1

    return reduce(Column.__and__, map(set_at, places(value, bits)))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    bits: int | None = None,
) -> DataFrame:
    """Find every occurrence of a benchmark window in every document.

    The windows' hashes go to all tasks as a set of bits, three a window, sized by the
    number of windows (``set_bits``: 2 MB at most; ``bits`` sets it by hand); each
    document tests its own windows against it inside its row, with no row per window.
    More than ``PASS_WINDOWS`` windows are split by ranges of their hashes, and the
    documents, written once, are tested in as many passes, so that neither the set nor
    the share of other windows that pass grows with the benchmark. What passes carries its words along and is verified
    by an exact join with the windows, which is a broadcast up to
    ``BROADCAST_WINDOWS`` rows and an ordinary join beyond.

    Returns one row per input row: ``id_column``, ``text_hash`` (xxhash64 of the
    text), ``n_words``, ``hits`` (sorted word positions from 0 inside any occurrence)
    and ``items`` (sorted distinct items as strings). Null and empty texts have no
    words and no hits; empty benchmark items are ignored; an empty benchmark hits
    nothing; null item ids count as occurrences without a name. Other columns are
    ignored.
    """
    windows = saved(benchmark_windows(benchmark, n, item_column), "windows")
    sizes = [r["len"] for r in windows.select("len").distinct().orderBy("len").collect()]  # at most n
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.xxhash64(F.col(text_column)).alias("text_hash"),
        words_of(F.col(text_column)).alias("words"),
    )
    total = windows.count()
    passes = max(1, -(-total // PASS_WINDOWS))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    if passes > 1:
        rows = saved(rows, "decontaminate-words")

    def in_pass(value: Column, number: int) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(passes)) == number if passes > 1 else F.lit(True)

    def candidates(size: int, number: int, bitmap: Column, width: int) -> Column:
        starts = F.when(F.size("words") >= size, F.sequence(F.lit(1), F.size("words") - size + 1)).otherwise(F.array().cast("array<int>"))

        def passes_set(i: Column) -> Column:
            value = F.xxhash64(F.slice("words", i, size))
            tested = in_set(bitmap, width, value)
            return in_pass(value, number) & tested if passes > 1 else tested

        return F.transform(
            F.filter(starts, passes_set),
            lambda i: F.struct(
                (i - 1).alias("start"), F.lit(size).alias("len"), F.array_join(F.slice("words", i, size), " ").alias("window")
            ),
        )

    def scan(number: int) -> DataFrame:
        part = windows.where(in_pass(F.col("hash"), number))
        width = bits or set_bits(-(-total // passes))
        bitmap = F.split(F.lit(",".join(map(str, hash_set(part, width)))), ",").cast("array<bigint>")
        found = F.concat(*[candidates(size, number, bitmap, width) for size in sizes])
        return rows.select("id", "text_hash", F.size("words").cast("long").alias("n_words"), "row", found.alias("found"))

    if sizes:
        scans = [saved(scan(number), "scanned") for number in range(passes)]
    else:
        nothing = F.expr("cast(array() as array<struct<start:int,len:int,window:string>>)")
        scans = [saved(rows.select("id", "text_hash", F.size("words").cast("long").alias("n_words"), "row", nothing.alias("found")), "scanned")]
    scanned = scans[0]
    spots = reduce(DataFrame.union, [s.select("row", F.inline("found")) for s in scans])
    few = total <= BROADCAST_WINDOWS

    def against(right: DataFrame) -> DataFrame:
        return F.broadcast(right) if few else right

    verified = spots.join(against(windows.select("len", "window").distinct()), ["len", "window"])
    verified = saved(verified.select("row", "start", "len", "window"), "verified")
    covered = verified.groupBy("row").agg(F.collect_set(F.struct("start", "len")).alias("spots"))
    spans = F.transform("spots", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))
    covered = covered.select("row", F.array_sort(F.array_distinct(F.flatten(spans))).alias("hits"))
    named = verified.select("row", "len", "window").distinct().join(against(windows.select("len", "window", "item")), ["len", "window"])
    named = named.select("row", F.col("item").cast("string").alias("item")).distinct()
    named = named.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    both = covered.join(named, "row", "left")
    return scanned.drop("found").join(both, "row", "left").select(
        F.col("id").alias(id_column),
        "text_hash",
        "n_words",
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``docs`` without contaminated documents (``documents``) or without the words hit (``spans``).

    Rows are told apart by id and text; columns stay as they were. In ``spans`` a word
    goes with the separators before it.
    """
    found = contaminated(docs, benchmark, id_column=id_column, text_column=text_column, **options)
    hit = found.where(F.size("hits") > 0).select(F.col(id_column).alias("__id"), F.col("text_hash").alias("__hash"), F.col("hits").alias("__hits"))
    hit = hit.dropDuplicates(["__id", "__hash"])
    same = docs[id_column].eqNullSafe(hit["__id"]) & (F.xxhash64(docs[text_column]) == hit["__hash"])
    if remove == "documents":
        return docs.join(hit, same, "left_anti")
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")
    separators = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"  # A-Z are word characters in the text as it stands
    pieces = F.regexp_extract_all(F.col(text_column), F.lit(separators + separators.replace("[", "[^")[:-1] + "+"), F.lit(0))
    tail = F.regexp_extract(F.col(text_column), separators + r"\z", 0)
    left = F.concat(F.array_join(F.filter(pieces, lambda p, i: ~F.array_contains("__hits", i)), ""), tail)
    text = F.when(F.col("__hits").isNull(), F.col(text_column)).otherwise(left)
    return docs.join(hit, same, "left").withColumn(text_column, text).drop("__id", "__hash", "__hits")
