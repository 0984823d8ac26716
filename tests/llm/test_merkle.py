"""Merkle manifest, multiproofs and verification against a tree built leaf by leaf."""

import hashlib
import random
import zlib

import pytest
from cases import awkward, awkward_rows, empty, in_order
from pyspark.sql import functions as F

from terrace.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels_of(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k : k + fanout]) for k in range(0, len(out[-1]), fanout)])
    return out


def path(levels, at, fanout):
    steps = []
    for nodes in levels[:-1]:
        start = at // fanout * fanout
        run = nodes[start : start + fanout]
        steps.append((at - start, run[: at - start] + run[at - start + 1 :]))
        at //= fanout
    return steps


def brute(rows, fanout=3):
    """(id, source, leaf) to (id, leaf, subroot, root, proof)."""
    groups = {}
    for i, source, leaf in sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(source, []).append((i, leaf))
    trees = [levels_of([leaf for _, leaf in members], fanout) for members in groups.values()]
    top = levels_of([t[-1][0] for t in trees], fanout)
    return [
        (i, leaf, tree[-1][0], top[-1][0], path(tree, at, fanout) + path(top, k, fanout))
        for k, (members, tree) in enumerate(zip(groups.values(), trees))
        for at, (i, leaf) in enumerate(members)
    ]


def plain(rows):
    return in_order((r["id"], r["leaf"], r["subroot"], r["root"], [(s["place"], list(s["siblings"])) for s in r["proof"]]) for r in rows)


def test_awkward_rows(spark):
    docs = awkward(spark)
    altered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle.document_proofs(docs, altered=altered).collect()
    want = brute([(r[0], r[3], leaf_of((r[0], r[3], r[2], r[4], r[1]))) for r in awkward_rows()])
    assert plain(got) == in_order(want)
    changed = {r[0] for r in awkward_rows() if r[0] and "\n" in (r[1] or "") and zlib.crc32(str(r[0]).encode()) % 2 == 0}
    assert changed and {r["id"] for r in got if r["folded"] != r["root"]} == changed
    assert merkle.document_proofs(empty(spark)).count() == 0


@pytest.mark.parametrize("sizes, fanout, levels", [([1], 3, 7), ([40, 1, 9, 27, 28, 2], 3, 2), ([130, 5, 5, 5, 5, 1, 64], 2, 3), ([100], 5, 1)])
def test_trees_and_proofs(spark, sizes, fanout, levels):
    rng = random.Random(3)
    rows = [(rng.randrange(60), None if s == 2 else f"s{s}é", h(str(rng.random()))) for s, size in enumerate(sizes) for _ in range(size)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "id int, source string, leaf string").repartition(3)
    tree = merkle.manifest(frame, fanout=fanout, levels=levels)
    want = brute(rows, fanout)
    assert tree.root == want[0][3]
    assert {(r["source"], r["subroot"]) for r in tree.sources.collect()} == {(s, w[2]) for i, s, leaf in rows for w in want if w[1] == leaf}
    proofs = merkle.multiproofs(tree)
    assert plain(proofs.collect()) == in_order(want)
    assert proofs.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0
    some = merkle.multiproofs(tree, F.col("id") % 7 == 1).collect()
    assert plain(some) == in_order(w for w in want if w[0] % 7 == 1)


def test_a_chunk_fetches_only_what_its_leaves_do_not_give(spark):
    rows = [(k, "a", h(str(k))) for k in range(81)]
    tree = merkle.manifest(spark.createDataFrame(rows, "id int, source string, leaf string"), levels=2)
    chunk = tree.leaves.where("chunk = 4").select("chunk", "tree", "at", "n").toArrow()
    got = merkle._missing(3, 1)(chunk).select(["tree", "level", "at"]).to_pylist()
    assert [(g["level"], g["at"]) for g in got] == [(2, 3), (2, 5), (3, 0), (3, 2)]
    one = merkle._missing(3, 1)(chunk.slice(0, 1)).num_rows
    assert one == 8
