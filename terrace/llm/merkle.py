"""A Merkle manifest of a dataset, and its proofs by one multiproof for each partition of leaves."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

TOP = -1  # the tree over the subroots
STEP = "struct<place: int, siblings: array<string>>"


def record_leaf(*values: Column) -> Column:
    """Hex SHA-256 of the values as text: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    texts = [v.cast("string") for v in values]
    fields = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*fields), 256)


def joined(hashes: list[str]) -> str:
    return hashlib.sha256("".join(hashes).encode()).hexdigest()


def parents(at: np.ndarray, hashes: list[str], fanout: int) -> tuple[np.ndarray, list[str]]:
    """The next level over whole runs of nodes in ascending order."""
    starts = np.flatnonzero(np.diff(at // fanout, prepend=-1))
    ends = [*starts[1:].tolist(), len(at)]
    return at[starts] // fanout, [joined(hashes[a:b]) for a, b in zip(starts.tolist(), ends)]


def ordered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` (a stored table) with ``part`` and ``ordinal``: 0, 1, ... in the order of ``keys``, null first.

    Rows are sorted in ranges, and one row per range gives the offsets. Rows equal in
    all keys, which may be very many, are spread by their place in the input.
    """
    spread = rows.withColumn("__place", F.monotonically_increasing_id())
    spread = spread.repartitionByRange(*keys, "__place").sortWithinPartitions(*keys, "__place").drop("__place")
    at = F.monotonically_increasing_id()
    spread = spread.withColumn("__at", at).withColumns({"part": F.shiftright("__at", 33), "__row": F.col("__at").bitwiseAND((1 << 33) - 1)})
    spread = saved(spread.drop("__at"), "ranges")
    sizes = spread.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # one row per range
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return spread.join(F.broadcast(offsets), "part").withColumn("ordinal", F.col("offset") + F.col("__row")).drop("offset", "__row")


@dataclass
class Manifest:
    """Stored tables of one tree: ``leaves`` (with ``tree``, ``at``, ``n`` and ``chunk``), interior ``nodes``, ``sources``; and the root."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame
    root: str | None
    fanout: int


def _grow(fanout: int, levels: int) -> Callable[[pa.Table], pa.Table]:
    """Up to ``levels`` levels over one block of nodes (tree, level, at, hash, n)."""

    def grow(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        tree, level, size = (block.column(c)[0].as_py() for c in ("tree", "level", "n"))
        at, hashes = block.column("at").to_numpy(), block.column("hash").to_pylist()
        out: list[list] = [[], [], [], []]
        for _ in range(levels):
            if size == 1:
                break
            at, hashes = parents(at, hashes, fanout)
            size, level = -(-size // fanout), level + 1
            for column, values in zip(out, ([level] * len(at), at.tolist(), hashes, [size] * len(at))):
                column += values
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int64())
        columns = [pa.array([tree] * len(out[0]), pa.int64()), *[pa.array(c, k) for c, k in zip(out, kinds)]]
        return pa.Table.from_arrays(columns, ["tree", "level", "at", "hash", "n"])

    return grow


def _interior(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """All nodes above ``nodes`` (level 0): blocks of ``fanout**levels`` nodes grow ``levels`` levels in one task each."""
    grown, level, current = [], 0, nodes
    while True:
        block = F.floor(F.col("at") / fanout**levels).alias("block")
        above = current.groupBy("tree", block).applyInArrow(_grow(fanout, levels), "tree long, level int, at long, hash string, n long")
        grown.append(saved(above, "nodes"))
        level += levels
        current = grown[-1].where((F.col("level") == level) & (F.col("n") > 1))
        if current.isEmpty():
            break
    found = grown[0]
    for more in grown[1:]:
        found = found.unionByName(more)
    return found


def manifest(
    leaves: DataFrame, source: str = "source", order: str = "id", leaf: str = "leaf", fanout: int = 3, levels: int = 7
) -> Manifest:
    """Build the tree over ``leaves``: one tree per source, and one over their subroots.

    Inside a source the leaves stand by ``order`` ascending (null first, equal values
    by leaf); sources stand by their UTF-8 bytes, null first. While several nodes
    remain, every ``fanout`` consecutive ones become the hash of their joined hex text.
    Other columns of ``leaves`` are kept. Positions come from sorted ranges and their
    offsets, so a source with a third of all rows is many ranges; levels are grown in
    blocks of ``fanout**levels`` nodes. An empty table has no root.
    """
    kept = saved(leaves, "leaves")
    rows = ordered(kept, [source, order, leaf])
    runs = rows.groupBy("part", source).agg(F.min("ordinal").alias("start"), F.count(F.lit(1)).alias("size"))
    runs = saved(runs, "source-runs")
    totals = saved(runs.groupBy(source).agg(F.min("start").alias("first"), F.sum("size").alias("n")), "sources")
    sources = ordered(totals, [source]).select(F.col(source).alias("__name"), F.col("ordinal").alias("tree"), "first", "n")
    places = runs.join(sources, F.col(source).eqNullSafe(F.col("__name")))
    places = saved(places.select(F.col("part").alias("__part"), "__name", "tree", "first", "n"), "places")
    placed = rows.join(places, (F.col("part") == F.col("__part")) & F.col(source).eqNullSafe(F.col("__name")))
    placed = placed.withColumn("at", F.col("ordinal") - F.col("first"))
    placed = placed.withColumn("chunk", F.floor(F.col("ordinal") / fanout**levels)).drop("part", "__part", "__name", "first", "ordinal")
    placed = saved(placed, "placed")

    nodes = _interior(placed.select("tree", F.lit(0).alias("level"), "at", F.col(leaf).alias("hash"), "n"), fanout, levels)
    single = placed.where("n = 1").select("tree", F.col(leaf).alias("hash"))
    subroots = nodes.where("n = 1").select("tree", "hash").unionByName(single)
    count = sources.count()
    ground = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"), "hash", F.lit(count).cast("long").alias("n")
    )
    ground = saved(ground, "subroots")
    top = ground.unionByName(_interior(ground, fanout, levels))
    root = top.where("n = 1").select("hash").first()
    named = sources.join(subroots, "tree").select(F.col("__name").alias(source), "tree", "n", F.col("hash").alias("subroot"))
    return Manifest(placed, nodes.unionByName(top), named, root and root["hash"], fanout)


def _missing(fanout: int, trees: int) -> Callable[[pa.Table], pa.Table]:
    """The coordinates that the proofs of one chunk's leaves need and cannot derive from each other."""

    def missing(chunk: pa.Table) -> pa.Table:
        tree, at, n = (chunk.column(c).to_numpy() for c in ("tree", "at", "n"))
        out: list[np.ndarray] = []

        def climb(name: int, known: np.ndarray, size: int) -> None:
            level = 0
            while size > 1:
                runs = np.unique(known // fanout)
                wanted = (runs[:, None] * fanout + np.arange(fanout)).ravel()
                wanted = np.setdiff1d(wanted[wanted < size], known, assume_unique=True)
                out.append(np.stack([np.full(len(wanted), name), np.full(len(wanted), level), wanted]))
                known, size, level = runs, -(-size // fanout), level + 1

        present = np.unique(tree)
        for name in present.tolist():
            climb(name, np.unique(at[tree == name]), int(n[tree == name][0]))
        climb(TOP, present, trees)
        found = np.concatenate(out, axis=1) if out else np.empty((3, 0), np.int64)
        number = chunk.column("chunk")[0].as_py()
        columns = [np.full(found.shape[1], number), found[0], found[1].astype(np.int32), found[2]]
        return pa.Table.from_arrays([pa.array(c) for c in columns], ["chunk", "tree", "level", "at"])

    return missing


def _expand(fanout: int, trees: int, kept: list[str], leaf: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Every leaf's own proof from one chunk's leaves and the nodes fetched for it."""

    def expand(chunk: pa.Table, fetched: pa.Table) -> pa.Table:
        known = dict(zip(zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "at"))), fetched.column("hash").to_pylist()))
        chunk = chunk.sort_by([("tree", "ascending"), ("at", "ascending")])
        tree, at, n = (chunk.column(c).to_numpy() for c in ("tree", "at", "n"))
        hashes = chunk.column(leaf).to_pylist()
        place: list[int] = []
        siblings: list[list[str]] = []  # one step for each node that lies on a path, shared by all leaves below it

        def climb(name: int, spots: np.ndarray, held: dict[int, str], size: int) -> tuple[list[np.ndarray], str]:
            steps, level = [], 0
            while size > 1:
                nodes, first, above = np.unique(spots), len(place), {}
                for node in nodes.tolist():
                    start = node // fanout * fanout
                    run = [held.get(k) or known[name, level, k] for k in range(start, min(start + fanout, size))]
                    place.append(node - start)
                    siblings.append(run[: node - start] + run[node - start + 1 :])
                    if node // fanout not in above:
                        above[node // fanout] = joined(run)
                steps.append(first + np.searchsorted(nodes, spots))
                spots, held, size, level = spots // fanout, above, -(-size // fanout), level + 1
            return steps, held[0]

        present, starts = np.unique(tree, return_index=True)
        subroots: dict[int, str] = {}
        paths = []
        for name, start, end in zip(present.tolist(), starts.tolist(), [*starts[1:].tolist(), len(tree)]):
            steps, subroots[name] = climb(name, at[start:end], dict(zip(at[start:end].tolist(), hashes[start:end])), int(n[start]))
            paths.append((start, end, steps))
        upper, root = climb(TOP, present, dict(subroots), trees)
        flat, lengths = [], []
        for index, (start, end, steps) in enumerate(paths):
            count = end - start
            both = np.array([*steps, *[np.full(count, u[index]) for u in upper]], np.int64).reshape(-1, count)
            flat.append(both.T.ravel())
            lengths.append(np.full(count, len(both)))
        pool = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(siblings, pa.list_(pa.string()))], ["place", "siblings"])
        ends = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype(np.int32)
        proof = pa.ListArray.from_arrays(pa.array(ends), pool.take(pa.array(np.concatenate(flat))))
        found = [chunk.column(c) for c in kept]
        found += [pa.array([subroots[t] for t in tree.tolist()], pa.string()), pa.array([root] * len(tree), pa.string()), proof]
        return pa.Table.from_arrays(found, [*kept, "subroot", "root", "proof"])

    return expand


def multiproofs(tree: Manifest, wanted: Column | None = None, leaf: str = "leaf") -> DataFrame:
    """The proofs of the leaves that ``wanted`` (default all) admits.

    Leaves are in chunks of consecutive ones. Each chunk works out the smallest set of
    nodes that all its proofs need and that do not follow from its own leaves; these
    are fetched in one join, the interiors that proofs share are computed once, and
    every leaf's proof is read off locally. Returns the columns of the manifest's
    leaves with ``subroot``, ``root`` and ``proof``: from the leaf up, the place in the
    run and the hashes of the others in it, left to right.
    """
    leaves = tree.leaves if wanted is None else tree.leaves.where(wanted)
    trees = tree.sources.count()
    coordinates = leaves.select("chunk", "tree", "at", "n").groupBy("chunk")
    coordinates = coordinates.applyInArrow(_missing(tree.fanout, trees), "chunk long, tree long, level int, at long")
    ground = tree.leaves.select("tree", F.lit(0).alias("level"), "at", F.col(leaf).alias("hash"))
    known = ground.unionByName(tree.nodes.select("tree", "level", "at", "hash"))
    fetched = saved(saved(coordinates, "coordinates").join(known, ["tree", "level", "at"]), "fetched")
    kept = [c for c in leaves.columns if c not in ("tree", "at", "n", "chunk")]
    shape = ", ".join(f"`{c}` {leaves.schema[c].dataType.simpleString()}" for c in kept)
    pairs = leaves.groupBy("chunk").cogroup(fetched.groupBy("chunk"))
    return pairs.applyInArrow(_expand(tree.fanout, trees, kept, leaf), f"{shape}, subroot string, root string, proof array<{STEP}>")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the siblings of its proof lead to."""

    def step(below: Column, at: Column) -> Column:
        left = F.slice(at["siblings"], F.lit(1), at["place"])
        right = F.slice(at["siblings"], at["place"] + 1, F.size(at["siblings"]))
        return F.sha2(F.concat_ws("", left, below, right), 256)

    return F.aggregate(proof, leaf, step)


def siblings_hash(proof: Column) -> Column:
    return F.sha2(F.concat_ws("", F.flatten(F.transform(proof, lambda step: step["siblings"]))), 256)


def document_proofs(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), altered: Column | None = None) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root``, ``proof`` and ``folded`` of every row of ``docs``.

    ``columns`` make the leaf, in this order; the first gives the order in a source and
    the second is the source. ``altered`` is what a reader finds in place of the last
    column (default: the same); ``folded`` is the root its leaf leads to with the
    original siblings, so it differs from ``root`` where a row was changed.

    Null values are part of the leaf; a null source is a source of its own, null ids
    come first in theirs, repeated rows are leaves of their own. Columns not named are
    ignored; an empty table gives no rows.
    """
    *head, last = [F.col(c) for c in columns]
    read = last if altered is None else altered
    leaves = docs.select(
        head[0].alias("id"), head[1].alias("source"), record_leaf(*head, last).alias("leaf"), record_leaf(*head, read).alias("found")
    )
    proofs = multiproofs(manifest(leaves))
    return proofs.select("id", "leaf", "subroot", "root", "proof", folded(F.col("found"), F.col("proof")).alias("folded"))
