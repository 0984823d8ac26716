"""Shards cut from a Hilbert order over several metadata dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

BROADCAST_TEXTS = 100_000
COPIES = 1000


def hilbert_indexes(bits: int, dimensions: int) -> list[int]:
    """The curve index of every cell, cells numbered with the first dimension in the highest bits."""
    side = 1 << bits
    out = [0] * side**dimensions
    for cell in range(len(out)):
        axes = [(cell >> (bits * (dimensions - 1 - d))) & (side - 1) for d in range(dimensions)]
        out[cell] = _hilbert_index(axes, bits)
    return out


def _hilbert_index(axes: list[int], bits: int) -> int:
    """Skilling's transform (2004): undo the excess rotations, Gray-encode, interleave."""
    x, q = list(axes), 1 << (bits - 1)
    while q > 1:
        for i in range(len(x)):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                swap = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            flip ^= q - 1
        q >>= 1
    x = [v ^ flip for v in x]
    index = 0
    for level in reversed(range(bits)):
        for v in x:
            index = index << 1 | v >> level & 1
    return index


def text_rank(column: Column, skip: int) -> Column:
    """Seven bytes after a common prefix as a number: keeps the order of code points, null first."""
    part = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), skip + 1, 7)), 14, "0")
    return F.coalesce(F.conv(part, 16, 10).cast("double"), F.lit(-1.0))


def quantised(column: Column, cuts: list[float]) -> Column:
    """How many cuts lie below the value."""
    if not cuts:
        return F.lit(0)
    return F.size(F.filter(F.lit(cuts), lambda cut: cut < column))


def copies(rows: DataFrame, block: int) -> DataFrame:
    """Every row ``n`` times, with ``position`` from ``first`` on; rows of many copies are dealt in blocks first."""

    def spread(df: DataFrame, start: Column, n: Column) -> DataFrame:
        return df.select("id", "size", "crc", "cell", F.explode(F.sequence(start, start + n - 1)).alias("position"))

    many = rows.where(F.col("n") > block).select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(n - 1) div {block}"))).alias("block"))
    many = many.repartition("first", "block")
    start, left = F.col("first") + F.col("block") * block, F.col("n") - F.col("block") * block
    few = spread(rows.where(F.col("n") <= block), F.col("first"), F.col("n"))
    return few.union(spread(many, start, F.least(left, F.lit(block))))


def hilbert_shards(
    docs: DataFrame,
    shards: int = 16,
    dimensions: tuple[str, ...] = ("source", "lang"),
    id_column: str = "doc_id",
    text_column: str = "text",
    bits: int = 4,
    run_rows: int = 2000,
) -> DataFrame:
    """Deal all rows into ``shards`` runs of a Hilbert order, by the law ``rows``.

    The dimensions are the text columns named and the size (UTF-8 bytes plus 1). Each
    is cut at quantiles into ``2**bits`` ranges; a cell's place on the curve comes
    from a table of all ``2**(bits * dimensions)`` cells. Rows of one cell are dealt
    to sub-runs of about ``run_rows`` by a hash of the text's checksum, so that a cell
    with a third of all rows is no single sort, and within a sub-run texts of equal
    checksum are next to each other: they share a shard unless its bound cuts them. A
    checksum with more than ``run_rows`` rows has sub-runs of its own, dealt by id, one
    after the other. Rows equal in id, size and checksum are counted, not sorted, so an
    id (or null) on a third of all rows is no long sub-run. Positions follow from row counts of cells and sub-runs, and
    position * shards div rows is the shard: counts differ by one at most.

    Returns ``id_column``, ``size``, ``text_crc32``, ``cell`` (curve index), ``shard``
    and ``slot`` (gapless from 0 within the shard). Null text has size 1 and the
    checksum of the empty text; null dimension values sort first; repeated rows get
    slots of their own. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = docs.select(
        F.col(id_column).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        *[F.col(d).cast("string").alias(f"d{i}") for i, d in enumerate(dimensions)],
    )
    base = saved(base, "shard-rows")
    ends = base.agg(*[f(f"d{i}").alias(f"{n}{i}") for i in range(len(dimensions)) for f, n in ((F.min, "lo"), (F.max, "hi"))])
    ends = ends.first()
    ranks = []
    for i in range(len(dimensions)):
        low, high = ((ends[f"{n}{i}"] or "").encode() for n in ("lo", "hi"))
        same = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        ranks.append(text_rank(F.col(f"d{i}"), same))
    ranks.append(F.col("size").cast("double"))
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = base.agg(*[F.percentile_approx(r, steps, 10000).alias(f"c{i}") for i, r in enumerate(ranks)]).first()
    cell = F.lit(0)
    for i, rank in enumerate(ranks):
        cell = cell * (1 << bits) + quantised(rank, sorted(set(cuts[f"c{i}"] or [])))
    curve = F.split(F.lit(",".join(map(str, hilbert_indexes(bits, len(ranks))))), ",").cast("array<int>")
    placed = base.select("id", "size", "crc", F.element_at(curve, (cell + 1).cast("int")).alias("cell"))
    placed = saved(placed, "shard-cells")

    # Rows that are told apart by nothing in the result are one row with a number of copies from here on.
    groups = saved(placed.groupBy("cell", "crc", "id", "size").agg(F.count(F.lit(1)).alias("n")), "shard-groups")
    cells = groups.groupBy("cell").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    cells = cells.select(  # at most one row per cell of the curve
        "cell",
        (F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("cell_start"),
        F.ceil(F.col("rows") / run_rows).alias("runs"),
    )
    large = groups.groupBy("cell", "crc").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > run_rows)
    large = saved(large.select("cell", "crc", F.ceil(F.col("rows") / run_rows).alias("parts")), "shard-large-texts")
    few = large.count() <= BROADCAST_TEXTS
    dealt = groups.join(F.broadcast(cells), "cell").join(F.broadcast(large) if few else large, ["cell", "crc"], "left")
    dealt = dealt.select(
        "cell", "cell_start", "crc", "id", "size", "n",
        F.pmod(F.xxhash64("crc"), F.col("runs")).alias("run"),
        F.when(F.col("parts").isNotNull(), F.col("crc")).otherwise(-1).alias("text"),
        F.coalesce(F.pmod(F.xxhash64("id", "size"), F.col("parts")), F.lit(0)).alias("part"),
    )
    dealt = saved(dealt, "shard-runs")
    key = ["cell", "run", "text", "part"]
    starts = dealt.groupBy(*key).agg(F.sum("n").alias("held"))
    before = Window.partitionBy("cell").orderBy("run", "text", "part").rowsBetween(Window.unboundedPreceding, 0)
    starts = starts.select(*key, (F.sum("held").over(before) - F.col("held")).alias("run_start"))
    order = Window.partitionBy(*key).orderBy("crc", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    first_of = F.col("cell_start") + F.col("run_start") + F.sum("n").over(order) - F.col("n")
    ranked = dealt.join(starts, key).select("id", "size", "crc", "cell", "n", first_of.alias("first"))
    ranked = copies(ranked, COPIES)
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shard = F.expr(f"position * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("position") - first)
        .select(
            F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"), "cell", "shard", F.col("slot").cast("long").alias("slot")
        )
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 16, id_column: str = "doc_id", text_column: str = "text", **options) -> None:
    """Write ``docs`` as ``folder``/shard=n, files as ranges of slots in slot order, so that files hold narrow ranges of every dimension.

    Rows find their slots by id, checksum and, among repeated rows, a number each. A
    column of ``docs`` named shard gives way to the new one.
    """
    crc = F.crc32(F.encode(F.coalesce(F.col(text_column), F.lit("")), "UTF-8"))
    dealt = hilbert_shards(docs, shards, id_column=id_column, text_column=text_column, **options)
    dealt = dealt.select(
        F.col(id_column).alias("__id"), F.col("text_crc32").alias("__crc"), "shard", F.col("slot").alias("__slot"),
        F.row_number().over(Window.partitionBy(id_column, "text_crc32").orderBy("shard", "slot")).alias("__nth"),
    )
    nth = F.row_number().over(Window.partitionBy(id_column, "__crc0").orderBy(F.xxhash64(*docs.columns)))
    rows = docs.withColumn("__crc0", crc).withColumn("__nth0", nth)
    same = rows[id_column].eqNullSafe(dealt["__id"]) & (rows["__crc0"] == dealt["__crc"]) & (rows["__nth0"] == dealt["__nth"])
    placed = rows.join(dealt, same).select(*[rows[c] for c in docs.columns if c != "shard"], dealt["shard"], "__slot")
    placed = placed.repartitionByRange("shard", "__slot").sortWithinPartitions("shard", "__slot")
    placed.drop("__slot").write.partitionBy("shard").parquet(folder)
