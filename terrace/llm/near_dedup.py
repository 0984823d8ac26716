"""Near-duplicates by bottom-k sketches, inverted lists, union-sketch estimates and exact Jaccard."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .components import connected
from .hashing import WordHasher, shingles

SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
BROADCAST_IDS = 200_000
LISTS = "list<item: int64>"


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64)))


def _batches(batches: Iterator[pa.RecordBatch], width: int, k: int | None) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, n, signature, values): the ``k`` smallest hashes, or all of them."""
    words = WordHasher(SEPARATORS)
    step = 512
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            sets = [shingles(words(t), width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.sha256(s.tobytes()).digest()[:16] for s in sets], pa.binary()),
                    _lists([s if k is None else s[:k] for s in sets]),
                ],
                ["id", "n", "signature", "vals"],
            )


def shingle_sets(rows: DataFrame, width: int, k: int | None) -> DataFrame:
    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(
        lambda batches: _batches(batches, width, k), f"id {kind}, n long, signature binary, vals array<long>"
    )


def least_overlap(n: Column, k: int, needed: int, percent: int) -> Column:
    """How many retained values any partner must share: all but certain for ``k``, exact below."""
    return F.least(F.lit(needed), F.ceil(n * percent / 100).cast("int"))


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, values of a, values of b) to (a, b, values in both)."""
    for batch in batches:
        x, y = batch.column(2), batch.column(3)
        both = [
            len(np.intersect1d(x[i].values.to_numpy(zero_copy_only=False), y[i].values.to_numpy(zero_copy_only=False), assume_unique=True))
            for i in range(batch.num_rows)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64())], ["a", "b", "both"])


class _Search:
    """The stored parts of one run."""

    def __init__(self, rows: DataFrame, width: int, k: int, needed: int, percent: int, hot_list: int):
        self.width, self.k, self.needed, self.percent, self.hot_list = width, k, needed, percent, hot_list
        self.rows = rows
        self.documents = saved(shingle_sets(rows, width, k), "sketches")
        classes = self.documents.where("n > 0").groupBy("signature")
        classes = classes.agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("vals").alias("vals"))
        self.classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        self.sketches = self.classes.select("node", "n", "vals")
        postings = saved(self._sketch_lists(), "postings")
        lengths = saved(postings.groupBy("value").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "lengths")
        cold = postings.join(lengths.where(F.col("length") <= hot_list).select("value"), "value")
        hot = postings.join(lengths.where(F.col("length") > hot_list).select("value"), "value", "left_semi").select("node").distinct()
        hot = saved(hot, "hot")
        self.sets = saved(self._full_sets(cold.select("node").unionByName(hot).distinct()), "sets")
        self.cores = self._cores(hot)
        self.cold = saved(self._with_pivots(cold, F.col("node")), "cold-lists")
        self.hot = saved(self._whole_lists(), "hot-lists")

    def _rarest(self, values: DataFrame, size: Column, least: Column) -> DataFrame:
        """(value, node, n) of each node's ``size - least + 1`` rarest values that occur twice or more.

        Two sets that share at least ``least`` of their values share one of the rarest
        so many of each, in any one order of all values; ordering by list length keeps
        common passages out of the lists.
        """
        common = values.groupBy("value").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
        values = values.join(common, "value", "left").withColumn("length", F.coalesce("length", F.lit(1)))
        rank = F.row_number().over(Window.partitionBy("node").orderBy("length", "value"))
        return values.withColumn("rank", rank).where(F.col("rank") <= size - least + 1).where("length > 1").select("value", "node", "n")

    def _sketch_lists(self) -> DataFrame:
        values = self.sketches.select("node", "n", F.size("vals").alias("m"), F.explode("vals").alias("value"))
        return self._rarest(values, F.col("m"), least_overlap(F.col("n"), self.k, self.needed, self.percent))

    def _cores(self, hot: DataFrame) -> DataFrame:
        """(node, n, core): of the hot classes' full sets, the values that another hot class has too."""
        values = self.sets.join(hot, "node").select("node", "n", F.explode("vals").alias("value"))
        shared = values.groupBy("value").agg(F.count(F.lit(1)).alias("length")).where("length > 1").select("value")
        cores = values.join(shared, "value").groupBy("node", "n").agg(F.sort_array(F.collect_list("value")).alias("core"))
        return saved(cores, "cores")

    def _whole_lists(self) -> DataFrame:
        """Exact lists of the hot classes over their whole sets, with the plainest member as pivot.

        A class whose values are too rarely shared to reach any partner has no list.
        """
        least = F.ceil(F.col("n") * self.percent / 100).cast("int")
        values = self.cores.where(F.size("core") >= least).select("node", "n", F.explode("core").alias("value"))
        lists = self._core_lists(values)
        odd = self.cores.select("node", (F.col("n") - F.size("core")).alias("odd"))
        return self._with_pivots(lists.join(odd, "node"), F.struct("odd", "node"))

    def _core_lists(self, values: DataFrame) -> DataFrame:
        """With ``left``: how many values, from the rarest on, a class has from this one on."""
        lengths = values.groupBy("value").agg(F.count(F.lit(1)).alias("length"))
        ranked = values.join(lengths, "value").withColumn(
            "rank", F.row_number().over(Window.partitionBy("node").orderBy("length", "value"))
        )
        held = F.count(F.lit(1)).over(Window.partitionBy("node"))
        least = F.ceil(F.col("n") * self.percent / 100)
        listed = ranked.withColumn("left", held - F.col("rank") + 1).where((F.col("left") >= least) & (F.col("length") > 1))
        return listed.select("value", "node", "n", "left")

    def _with_pivots(self, lists: DataFrame, order: Column) -> DataFrame:
        """(value, node, n, pivot) of lists with two members or more."""
        shared = lists.groupBy("value").agg(F.count(F.lit(1)).alias("length"), F.min_by("node", order).alias("pivot")).where("length > 1")
        return lists.join(shared.select("value", "pivot"), "value")

    def _full_sets(self, nodes: DataFrame) -> DataFrame:
        """The whole shingle sets of classes that stand in some list, from one document of each."""
        wanted = saved(nodes.join(self.classes.select("node", "signature", "rep"), "node"), "wanted")
        ids = wanted.select("rep").distinct()
        if wanted.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        texts = self.rows.join(ids, self.rows["id"].eqNullSafe(ids["rep"]), "left_semi")
        found = shingle_sets(texts, self.width, None).withColumnRenamed("id", "found")
        found = found.join(wanted.select("node", "signature"), "signature")
        return found.select("node", "n", "vals").dropDuplicates(["node"])

    def enough(self, both: Column, n_a: Column, n_b: Column) -> Column:
        return both * 100 >= (n_a + n_b - both) * self.percent

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sketch of the union leaves the similarity possible, with the estimate."""
        a = self.sketches.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("vals").alias("s"))
        b = self.sketches.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("vals").alias("t"))
        sized = pairs.join(a, "a").join(b, "b").where(self.enough(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b")))
        sized = sized.withColumn("u", F.slice(F.array_sort(F.array_union("s", "t")), 1, self.k))
        shared = F.size(F.array_intersect(F.array_intersect("s", "t"), "u"))
        enough = F.when(F.size("u") < self.k, F.ceil(F.size("u") * self.percent / 100)).otherwise(F.lit(self.needed))
        return sized.withColumn("estimate", shared / F.size("u")).where(shared >= enough).select("a", "b", "estimate")

    def counted(self, pairs: DataFrame, sets: DataFrame, values: str) -> DataFrame:
        """(a, b, both): how many values the sets of each pair share, whole sets compared."""
        a = sets.select(F.col("node").alias("a"), F.col(values).alias("s"))
        b = sets.select(F.col("node").alias("b"), F.col(values).alias("t"))
        whole = pairs.join(a, "a").join(b, "b").select("a", "b", "s", "t")
        return whole.mapInArrow(_overlaps, "a long, b long, both long")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Links among the pairs."""
        both = self.counted(pairs, self.sets, "vals")
        sizes = [self.classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab"]
        sized = both.join(sizes[0], "a").join(sizes[1], "b")
        return sized.where(self.enough(F.col("both"), F.col("n_a"), F.col("n_b"))).select("a", "b")

    def labelled(self, nodes: DataFrame, groups: DataFrame) -> DataFrame:
        return nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def star(self, lists: DataFrame) -> DataFrame:
        """Each list's members with its pivot."""
        return lists.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()

    def across(self, lists: DataFrame, groups: DataFrame) -> DataFrame:
        """Pairs of a list's members in different components that may share enough.

        The list's largest component meets the others only. At most ``most`` values lie in
        the pivot and ``rest`` outside it; two members share at most the smaller of each.
        In the list of the rarest value they share, they share no more than either has
        ``left``.
        """
        members = saved(self.labelled(lists, groups), "members")
        parts = members.groupBy("value", "component").agg(F.count(F.lit(1)).alias("size"))
        largest = parts.groupBy("value").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
        open_lists = members.join(largest.where("parts > 1"), "value")
        names = ("node", "n", "component", "most", "rest", "left")
        a = open_lists.where("component != main").select("value", *[F.col(c).alias(f"{c}_a") for c in names])
        b = open_lists.select("value", "main", *[F.col(c).alias(f"{c}_b") for c in names])
        ceiling = F.least("left_a", "left_b", F.least("most_a", "most_b") + F.least("rest_a", "rest_b"))
        once = "component_a != component_b AND (component_b = main OR node_a < node_b)"
        pairs = a.join(b, (a["value"] == b["value"]) & F.expr(once) & self.enough(ceiling, F.col("n_a"), F.col("n_b")))
        return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 75,
    k: int = 32,
    needed: int = 12,
    hot_list: int = 32,
) -> DataFrame:
    """Group documents linked by ``100 * |A and B| >= percent * |A or B|`` over ``width``-word shingles.

    Rows of equal sets form one class first. A class keeps its ``k`` smallest shingle
    hashes; the values' inverted lists name the candidates, and the bottom-k sketch of a
    pair's union estimates its similarity. Of k values of that sketch at least
    ``percent`` % are expected to be shared; fewer than ``needed`` of 32 at exactly 75 %
    have a chance of about 2 in a million, and classes with fewer than k shingles are
    exact. Classes in lists of more than ``hot_list`` members are listed once more by
    their whole sets, where the bound on what a partner must share is exact: what only
    has a common passage has no list then, and of large groups of near copies the
    plainest member is the pivot of its lists. Only links between what is not yet
    connected are looked for: first members against pivots, then members of different
    components, as far as their shares of the pivot leave a link possible. No list is
    cut. Every link is confirmed on full sets.

    Returns one row per input row: ``id_column``, ``n_shingles``, ``component_id``
    (smallest id reachable) and ``kept``. Null text counts as empty: no shingles,
    linked with nothing, a component of its own. Null ids win against nothing; a
    component of null ids only has a null id and its rows are kept. Repeated rows share
    component and ``kept``. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    search = _Search(rows, width, k, needed, percent, hot_list)

    # Members against pivots: in hot lists all, with the exact number of shared values; else the best pivot of each class.
    pivots = saved(search.counted(search.star(search.hot), search.cores, "core"), "pivot-overlaps")
    sizes = [search.cores.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab"]
    near = pivots.join(sizes[0], "a").join(sizes[1], "b").where(search.enough(F.col("both"), F.col("n_a"), F.col("n_b")))
    star = search.estimated(search.star(search.cold))
    best = star.groupBy("b").agg(F.max_by("a", F.struct("estimate", "a")).alias("a")).select("a", "b")
    links = near.select("a", "b").unionByName(search.confirmed(best))
    groups = saved(connected(saved(links, "links")), "groups")

    # Then the members of a list that lie in different components.
    size = F.size("core")
    both = F.when(F.col("node") == F.col("pivot"), size).otherwise(F.col("both"))
    hot = search.hot.join(search.cores.select("node", "core"), "node")
    hot = hot.join(pivots.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "both"), ["pivot", "node"], "left")
    hot = hot.select("value", "node", "n", both.alias("most"), (size - both).alias("rest"), "left")
    cold = search.cold.select("value", "node", "n", *[F.col("n").alias(c) for c in ("most", "rest", "left")])
    pairs = saved(search.across(hot.unionByName(cold), groups), "pairs")
    links = saved(search.confirmed(search.estimated(pairs).select("a", "b")), "links")
    if not links.isEmpty():
        forest = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        groups = saved(connected(links.unionByName(forest)), "groups")
    classes = search.labelled(search.classes.select("node", "signature", "rep"), groups)
    smallest = classes.groupBy("component").agg(F.min("rep").alias("component_id"))
    classes = saved(classes.join(smallest, "component").select("signature", "component_id"), "membership")
    out = search.documents.select("id", "n", "signature").join(classes, "signature", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
