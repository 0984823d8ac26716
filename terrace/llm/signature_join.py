"""N-gram Jaccard join by keys of parts and signature trees: OR-combined token bitmaps and size ranges, walked in pairs."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .components import connected
from .hashing import WordHasher, mix, shingles
from .near_dedup import BROADCAST_IDS, SEPARATORS, _lists

TOKENS = 1 << 20  # tokens and sets that one task holds of a block
SETS = 1 << 10
WIDE = 1.4  # a size range's largest size by its smallest one
EMPTY = 32  # one part in so many more is cut than the pigeonhole needs, so that some may be empty
DEALS = 3
FAN = 8
BITS = 1 << 14
PAIRS = 1 << 12


def least_shared(n_a, n_b, percent: int):
    """How many tokens similar sets of these sizes share."""
    return -(-(n_a + n_b) * percent // (100 + percent))


# ---- keys --------------------------------------------------------------------------------------------


@lru_cache
def size_ranges(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest size of each size range, and the most tokens in which two similar sets differ if the smaller one is of that range.

    The larger one is of the same or the next range.
    """
    ends = [0]
    while ends[-1] < 1 << 40:
        low = ends[-1] + 1
        ends.append(max(low, int(low * WIDE), 100 * low // percent))
    both = [high + 100 * high // percent for high in ends[1:]]
    return np.array(ends[1:], np.int64), np.array([t * (100 - percent) // (100 + percent) for t in both], np.int64)


@lru_cache(maxsize=64)
def _cuts(scheme: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the parts of the 64-bit values begin, but for the first, and a name of each."""
    starts = np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts)
    return starts, mix(np.arange(parts, dtype=np.uint64) + np.uint64(scheme + 1 << 40))


def _scheme_keys(values: np.ndarray, scheme: int, differ: int) -> list[np.ndarray]:
    """Keys of the parts, for sets that differ in at most ``differ`` tokens.

    Such sets agree in ``spare + 1`` parts or more, so in one that is not empty if one
    of them has at most ``spare`` empty parts. Sets with more are dealt into parts anew,
    and with the last deal their empty parts are keys too.
    """
    spare = differ // EMPTY
    starts, names = _cuts(scheme, differ + 1 + spare)
    out = []
    for deal in range(DEALS):
        if deal:
            values, names = np.sort(mix(values + np.uint64(deal))), mix(names + np.uint64(deal))
        edges = np.concatenate([[0], np.searchsorted(values, starts), [len(values)]])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values))])[edges]
        keys, full = mix(np.diff(sums) + names), np.diff(edges) > 0
        done = len(full) - int(full.sum()) <= spare
        out.append(keys if deal == DEALS - 1 and not done else keys[full])
        if done:
            break
    return out


def part_keys(values: np.ndarray, percent: int) -> np.ndarray:
    """Keys (int64) of a set of sorted int64 tokens: any two similar sets that are not equal share one.

    The token space is cut into more parts than similar sets have tokens in which they
    differ, so in some part they agree; a key stands for all tokens of a part. The number
    of parts follows from the size range of the smaller set, so a set also has the keys of
    the range below if a partner may be there. Sets too small to differ have no key.
    """
    n = len(values)
    ends, differ = size_ranges(percent)
    own = int(np.searchsorted(ends, n))
    values = np.sort(values.view(np.uint64))
    out: list[np.ndarray] = []
    for scheme in (own - 1, own):
        if scheme >= 0 and differ[scheme] and (scheme == own or 100 * int(ends[scheme]) >= percent * n):
            out += _scheme_keys(values, scheme, int(differ[scheme]))
    return np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)


def _signature(values: np.ndarray) -> bytes:
    return hashlib.sha256(values.tobytes()).digest()[:16]


def _keyed(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, n, signature, keys)."""
    words = WordHasher(SEPARATORS)
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            sizes, signatures, keys = [], [], []
            for text in batch.column(1).to_pylist():
                values = shingles(words(text), width)
                sizes.append(len(values)), signatures.append(_signature(values)), keys.append(part_keys(values, percent))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(signatures, pa.binary()), _lists(keys)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "signature", "keys"])


def _signed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(text) to (signature, text)."""
    words = WordHasher(SEPARATORS)
    for batch in batches:
        signatures = [_signature(shingles(words(text), width)) for text in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(signatures, pa.binary()), batch.column(0)], ["signature", "text"])


def shared_keys(documents: DataFrame) -> DataFrame:
    """(token, node, length): the keys that more than one class has, with their classes. All keys are shuffled once by class and once by key."""
    listed = documents.where(F.size("keys") > 0).groupBy("signature").agg(F.min("row").alias("node"), F.min_by("keys", "row").alias("keys"))
    postings = listed.select(F.explode("keys").alias("token"), "node")
    counted = postings.withColumn("length", F.count(F.lit(1)).over(Window.partitionBy("token")))
    return saved(counted.where("length > 1"), "shared")


def groups_of(shared: DataFrame) -> DataFrame:
    """(grp, node, weight): lists that lead to the same longest list are one group, so a set meets a partner once, not in every list they share.

    A node's home is the longest list it stands in; a list belongs to the largest home
    of its members. Every two members of a list are members of its group.
    """
    home = shared.groupBy("node").agg(F.max(F.struct("length", "token")).alias("home"))
    homed = shared.join(home, "node")
    owners = homed.groupBy("token").agg(F.max("home").alias("owner"))
    members = shared.join(owners, "token").groupBy(F.col("owner.token").alias("grp"), "node").agg(F.sum("length").alias("weight"))
    return saved(members, "members")


# ---- trees -------------------------------------------------------------------------------------------


class Forest:
    """Components of one task's sets: the smallest label found so far."""

    def __init__(self, labels: list[int]):
        self.parent: dict[int, int] = {label: label for label in labels}

    def root(self, label: int) -> int:
        while self.parent[label] != label:
            self.parent[label] = label = self.parent[self.parent[label]]
        return label

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def bitmaps(sets: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A bitmap of each set's tokens that another set of the task has too, and how many of them fell on a bit already set.

    Tokens get places from a common dictionary; while that has no more than ``bits``
    entries the bitmaps are exact.
    """
    lengths = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), lengths)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    number = np.cumsum(count > 1) - 1
    place, owner = number[place[shared]], owner[shared]
    width = max(64, min(bits, -(-int(number[-1] + 1) // 64) * 64))
    grid = np.zeros((len(sets), width), bool)
    grid[owner, place % width] = True
    maps = np.packbits(grid, axis=1).view(np.uint64)
    return maps, np.bincount(owner, minlength=len(sets)) - np.bitwise_count(maps).sum(axis=1).astype(np.int64)


class Tree:
    """Levels of nodes over sets in an order that keeps similar ones together; the last level is one root."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, folded: np.ndarray):
        self.levels = [(maps, sizes, sizes, folded)]
        while len(self.levels[-1][0]) > 1:
            maps, low, high, folded = self.levels[-1]
            starts = np.arange(0, len(maps), FAN)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, starts),
                    np.minimum.reduceat(low, starts),
                    np.maximum.reduceat(high, starts),
                    np.maximum.reduceat(folded, starts),
                )
            )

    def labels(self, leaves: np.ndarray) -> list[np.ndarray]:
        """For each level the label that all sets below a node have, or -1."""
        out = [leaves]
        for _ in self.levels[1:]:
            starts = np.arange(0, len(out[-1]), FAN)
            low, high = np.minimum.reduceat(out[-1], starts), np.maximum.reduceat(out[-1], starts)
            out.append(np.where(low == high, low, -1))
        return out

    def possible(
        self, level: int, x: np.ndarray, other: Tree, y: np.ndarray, percent: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """Whether some pair of sets below nodes ``x`` and ``y`` can be similar, by the most they can share; and that number."""
        maps, low, high, folded = self.levels[level]
        maps_y, low_y, high_y, folded_y = other.levels[level]
        most = np.empty(len(x), np.int64)
        for k in range(0, len(x), PAIRS):
            a, b = x[k : k + PAIRS], y[k : k + PAIRS]
            most[k : k + PAIRS] = np.bitwise_count(maps[a] & maps_y[b]).sum(axis=1)
        most = np.minimum(most + np.minimum(folded[x], folded_y[y]), np.minimum(high[x], high_y[y]))
        fits = (100 * high[x] >= percent * low_y[y]) & (100 * high_y[y] >= percent * low[x])
        return fits & (most >= least_shared(low[x], low_y[y], percent)), most


class Walk:
    """Walks pairs of nodes of two trees (or of one with itself) and joins similar sets of different components."""

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray, labels: list[int], percent: int):
        self.sets, self.sizes, self.start, self.percent = sets, sizes, labels, percent
        self.forest = Forest(labels)
        self.maps, self.folded = bitmaps(sets, BITS)
        self.exact = not self.folded.any()
        self.links: list[tuple[int, int]] = []

    def tree(self, members: np.ndarray) -> Tree:
        return Tree(self.maps[members], self.sizes[members], self.folded[members])

    def labels(self, members: np.ndarray) -> np.ndarray:
        roots = {label: self.forest.root(label) for label in set(self.start)}
        return np.array([roots[self.start[m]] for m in members.tolist()], np.int64)

    def verify(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> None:
        """Link the pairs that are similar, as long as they are in different components."""
        for i, j, both in zip(a.tolist(), b.tolist(), most.tolist()):
            if self.forest.root(self.start[i]) != self.forest.root(self.start[j]):
                if not self.exact:
                    both = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
                if both >= least_shared(self.sizes[i], self.sizes[j], self.percent):
                    self.forest.join(self.start[i], self.start[j])
                    self.links.append((i, j))

    def star(self, members: np.ndarray, pivot: int) -> None:
        """All members against one, so that groups of near copies are one component before the walk."""
        others = members[members != pivot]
        ends = self.tree(others), self.tree(np.array([pivot]))
        index = np.arange(len(others))
        fits, most = ends[0].possible(0, index, ends[1], np.zeros(len(others), np.int64), self.percent)
        self.verify(others[fits], np.full(int(fits.sum()), pivot), most[fits])

    def join(self, left: np.ndarray, right: np.ndarray | None = None) -> None:
        """Depth-first in batches of node pairs; a pair all of whose sets are one component by then is skipped."""
        x, y = self.tree(left), self.tree(left if right is None else right)
        itself = right is None
        stack = []
        for level in range(len(x.levels)):
            if level == len(x.levels) - 1 or level == len(y.levels) - 1:
                a, b = np.meshgrid(np.arange(len(x.levels[level][0])), np.arange(len(y.levels[level][0])), indexing="ij")
                stack.append((level, a.ravel(), b.ravel()))
                break
        if itself:
            level, a, b = stack.pop()
            stack.append((level, a[a <= b], b[a <= b]))
        members = left, (left if itself else right)
        seen = None
        while stack:
            level, a, b = stack.pop()
            if seen is None or len(self.links) > seen + len(self.sets) // 32:  # older labels only skip less
                seen = len(self.links)
                mine, yours = x.labels(self.labels(members[0])), y.labels(self.labels(members[1]))
            here, there = mine[level][a], yours[level][b]
            fits = (here < 0) | (here != there)
            a, b = a[fits], b[fits]
            fits, most = x.possible(level, a, y, b, self.percent)
            a, b, most = a[fits], b[fits], most[fits]
            if level == 0:
                self.verify(members[0][a], members[1][b], most)
                continue
            for k in range(0, len(a), PAIRS // FAN**2):
                below = [np.arange(FAN) + FAN * part[k : k + PAIRS // FAN**2, None] for part in (a, b)]
                child_a, child_b = np.repeat(below[0], FAN, axis=1).ravel(), np.tile(below[1], (1, FAN)).ravel()
                inside = (child_a < len(x.levels[level - 1][0])) & (child_b < len(y.levels[level - 1][0]))
                if itself:
                    inside &= child_a <= child_b if level > 1 else child_a < child_b
                if inside.any():
                    stack.append((level - 1, child_a[inside], child_b[inside]))


def arranged(sets: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    """Order by the smallest tokens, then by size: near copies mostly share those, so they become neighbours."""
    least = np.array([[s[0], s[min(1, len(s) - 1)]] for s in sets], np.int64).reshape(-1, 2)
    return np.lexsort((sizes, least[:, 1], least[:, 0]))


def _read(table: pa.Table, width: int) -> tuple[list[int], np.ndarray, list[np.ndarray]]:
    words = WordHasher(SEPARATORS)
    sets = [shingles(words(text.as_py()), width) for text in table.column("text")]
    return table.column("node").to_pylist(), table.column("n").to_numpy(), sets


def _named(links: list[tuple[int, int]], nodes: list[int]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([nodes[i] for i, _ in links], pa.int64()), pa.array([nodes[j] for _, j in links], pa.int64())], ["a", "b"])


def _within(width: int, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links inside one block (node, n, text, pivot): first with the pivots, then by its tree."""

    def within(block: pa.Table) -> pa.Table:
        nodes, sizes, sets = _read(block, width)
        if len(nodes) < 2:
            return _named([], nodes)
        walk = Walk(sets, sizes, nodes, percent)
        members = arranged(sets, sizes)
        pivots = np.flatnonzero(block.column("pivot").to_numpy(zero_copy_only=False))
        for pivot in pivots.tolist():
            walk.star(members, pivot)
        walk.join(members)
        return _named(walk.links, nodes)

    return within


def _across(width: int, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links between two blocks (node, n, text, component, side) among sets of different components."""

    def across(both: pa.Table) -> pa.Table:
        nodes, sizes, sets = _read(both, width)
        side = both.column("side").to_numpy()
        if len(nodes) < 2 or side.min() == side.max():
            return _named([], nodes)
        walk = Walk(sets, sizes, both.column("component").to_pylist(), percent)
        order = arranged(sets, sizes)
        walk.join(order[side[order] == 0], order[side[order] == 1])
        return _named(walk.links, nodes)

    return across


# ---- the join ----------------------------------------------------------------------------------------


def _blocks(members: DataFrame, percent: int, tokens: int, sets: int) -> DataFrame:
    """(grp, band, salt, node, n, pivot): groups too large for a task are cut by size range and a hash.

    Similar sets lie in the same or the next size range. Every block of a cut group
    also has the pivot of its own range and of the one below, the member in the longest lists.
    """
    sized = members.groupBy("grp").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    small = (F.col("tokens") <= tokens) & (F.col("sets") <= sets)
    band = F.when(small, 0).otherwise(F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(min(percent, 99) / 100)))).cast("int")
    placed = saved(members.join(sized, "grp").withColumn("band", band), "placed")
    ranges = placed.groupBy("grp", "band").agg(
        F.greatest(F.ceil(F.sum("n") / tokens), F.ceil(F.count(F.lit(1)) / sets)).alias("salts"),
        F.max_by("node", F.struct("weight", "node")).alias("pivot"),
    )
    ranges = saved(ranges, "ranges")
    own = placed.join(ranges, ["grp", "band"]).withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")))
    own = own.select("grp", "band", "salt", "node", "n", (F.col("node") == F.col("pivot")).alias("pivot"))
    cut = ranges.join(sized.where(~small).select("grp"), "grp").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    lent = cut.select("grp", "band", "salt", "pivot")
    below = ranges.select("grp", (F.col("band") + 1).alias("band"), F.col("pivot").alias("lower"))
    lent = lent.select("grp", "band", "salt", F.col("pivot").alias("node")).unionByName(
        lent.join(below, ["grp", "band"]).select("grp", "band", "salt", F.col("lower").alias("node"))
    )
    lent = lent.join(own.select("grp", "node", "n").distinct(), ["grp", "node"]).withColumn("pivot", F.lit(True))
    lent = lent.join(own.select("grp", "band", "salt", "node"), ["grp", "band", "salt", "node"], "left_anti")
    return own.withColumn("lent", F.lit(False)).unionByName(lent.withColumn("lent", F.lit(True)))


def _open_pairs(blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """(grp, band, salt, pair, side) of blocks of one group that hold different components and sizes that may fit."""
    labelled = blocks.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    kinds = labelled.groupBy("grp", "band", "salt").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    a = kinds.select("grp", *[F.col(c).alias(f"{c}_a") for c in ("band", "salt", "low", "high")])
    b = kinds.select("grp", *[F.col(c).alias(f"{c}_b") for c in ("band", "salt", "low", "high")])
    near = (F.col("band_b") - F.col("band_a") == 1) | ((F.col("band_a") == F.col("band_b")) & (F.col("salt_a") < F.col("salt_b")))
    settled = (F.col("low_a") == F.col("high_a")) & (F.col("low_b") == F.col("high_b")) & (F.col("low_a") == F.col("low_b"))
    pairs = a.join(b, "grp").where(near & ~settled).withColumn("pair", F.monotonically_increasing_id())
    pairs = saved(pairs, "block-pairs")
    sides = [pairs.select("grp", F.col(f"band_{s}").alias("band"), F.col(f"salt_{s}").alias("salt"), "pair", F.lit(k).alias("side")) for k, s in enumerate("ab")]
    return sides[0].unionByName(sides[1])


def _with_texts(members: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``members`` (node, ...) of ``classes`` (node, signature, rep, ...) with a text of each class, which is shuffled by signature only."""
    ids = classes.select("rep").distinct()
    if classes.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    found = texts.join(ids, texts["id"].eqNullSafe(ids["rep"]), "left_semi").select("text")
    found = found.mapInArrow(lambda b: _signed(b, width), "signature binary, text binary").dropDuplicates(["signature"])
    return found.join(members.join(classes.select("node", "signature"), "node"), "signature").drop("signature")


def similar_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 3,
    percent: int = 90,
    share: float = 0.0005,
    frequent: int = 1 << 20,
    block_tokens: int = TOKENS,
    block_sets: int = SETS,
) -> DataFrame:
    """Components of the documents linked by ``100 * |A and B| >= percent * |A or B|`` over ``width``-word shingles.

    Rows of equal sets form one class. A class is listed under the keys of its parts (see
    ``part_keys``), of which any partner shares one; a passage in common makes no common
    key unless it holds all tokens of a part. Lists that lead to the same longest list are
    one group, and all partners meet in some group. The whole sets of a group stand in
    signature trees: nodes hold the OR of their sets' token bitmaps and the range of
    their sizes; pairs of nodes are walked from the root down and dropped where the
    most their sets can share is too little, or where all their sets are connected
    already. Bitmaps of up to 16384 shared tokens are exact, beyond that pairs are
    confirmed on whole sets. A group too large for a task is cut by size and hash, its
    blocks are joined in themselves with common pivots, and then those pairs of blocks
    that still hold different components are walked. No list, group or pair is cut off.
    Texts move instead of sets, which take more room, and only those in some list.
    ``share`` and ``frequent`` are accepted and change nothing: keys need no order of tokens.

    Returns one row per input row: ``id_column``, ``n_shingles``, ``component_id``
    (smallest id reachable) and ``kept``. Null text counts as empty: no shingles,
    linked with nothing, a component of its own. A component of null ids only has a
    null id. Repeated rows share their component. Other columns are ignored.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    texts = rows.select("id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    keyed = texts.mapInArrow(lambda b: _keyed(b, width, percent), f"id {kind}, n long, signature binary, keys array<long>")
    documents = saved(keyed.withColumn("row", F.monotonically_increasing_id()), "keys")
    classes = documents.where("n > 0").groupBy("signature").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.min("row").alias("node"))
    classes = saved(classes, "classes")
    members = groups_of(shared_keys(documents))

    wanted = saved(members.select("node").distinct().join(classes, "node"), "wanted")
    blocks = _blocks(members.join(wanted.select("node", "n"), "node"), percent, block_tokens, block_sets)
    blocks = saved(blocks, "blocks")
    filled = _with_texts(blocks, wanted, texts, width).groupBy("grp", "band", "salt")
    links = saved(filled.applyInArrow(_within(width, percent), "a long, b long"), "links")
    groups = saved(connected(links), "groups")
    own = blocks.where("not lent").select("grp", "band", "salt", "node", "n")
    cut = own.join(own.select("grp", "band", "salt").distinct().groupBy("grp").count().where("count > 1").select("grp"), "grp")
    sides = _open_pairs(cut, groups)
    if not sides.isEmpty():
        split = sides.join(cut, ["grp", "band", "salt"]).join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        split = saved(split, "block-sides")
        open_classes = wanted.join(split.select("node"), "node", "left_semi")
        more = _with_texts(split, open_classes, texts, width).groupBy("pair").applyInArrow(_across(width, percent), "a long, b long")
        more = saved(more, "more-links")
        groups = saved(connected(more.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))), "groups")
    return _answer(documents, classes, groups, id_column)


def _answer(documents: DataFrame, classes: DataFrame, groups: DataFrame, id_column: str) -> DataFrame:
    labelled = classes.select("node", "signature", "rep").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = saved(labelled.join(smallest, "component").select("signature", "component_id"), "membership")
    out = documents.select("id", "n", "signature").join(named, "signature", "left")
    component: Column = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )
