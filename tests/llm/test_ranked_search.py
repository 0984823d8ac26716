"""Ranked search against brute force."""

import math
import random
from collections import Counter

import pytest
from cases import awkward, awkward_rows, empty, in_order, prose, words

from terrace.llm import ranked_search as search


def brute(docs, items, k=10):
    held = [(i, words(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, length = len(held), sum(len(w) for _, w in held)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(words(text))
    counted = [(i, len(w), Counter(w)) for i, w in held]
    df = Counter(t for _, _, c in counted for t in c)
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, n, c in counted:
            m = 100 - 90 + (90 * n * n_docs) // length
            score = 0
            for t in terms & c.keys():
                tf = c[t]
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k], 1)]
    return out


def got(df):
    return in_order(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


ITEMS = [(1, "alpha beta gamma0 Gamma0 MIT license"), (2, "the TWO one"), (3, None), (4, "!!"), (None, "ünï \U0001f600x çödé"), (5, "a"), (5, "c b"), (6, prose(3, 70))]


def items_of(spark):
    rows = [(i, t, "clash", 3) for i, t in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, score string, n long")


def test_awkward_rows(spark):
    want = in_order(brute([r[:2] for r in awkward_rows()], ITEMS))
    assert got(search.ranked_search(awkward(spark), items_of(spark))) == want
    assert got(search.ranked_search(awkward(spark), items_of(spark), chunk_terms=60, block_rows=3)) == want


def test_empty_tables(spark):
    assert search.ranked_search(empty(spark), items_of(spark)).count() == 0
    assert search.ranked_search(awkward(spark), items_of(spark).limit(0)).count() == 0


@pytest.mark.parametrize("block_rows, partitions", [(4096, 1), (512, 3)])
def test_common_words_copies_and_ties(spark, block_rows, partitions):
    rng = random.Random(5)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))) for k in range(1500)]
    docs += [(9000 + k, docs[7][1]) for k in range(200)] + [(5000 + k, "t1 t2 " * k) for k in range(30)]
    rng.shuffle(docs)
    items = [(k, " ".join(rng.choices(vocabulary, k=25))) for k in range(20)] + [(100, docs[3][1]), (101, "t1"), (102, dict(docs)[7])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(partitions)
    wanted = spark.createDataFrame(items, "item_id long, text string")
    assert got(search.ranked_search(frame, wanted, block_rows=block_rows)) == in_order(brute(docs, items))


def test_accumulators_stop_and_survivors_stay_exact(spark):
    """A block's search with a bound from earlier blocks leaves out nothing that reaches it."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(8)
    vocabulary = {f"t{k}".encode(): k for k in range(40)}
    texts = [" ".join(f"t{min(39, int(rng.expovariate(0.15)))}" for _ in range(20)).encode() for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(texts, pa.binary())], ["id", "text"])
    rows = list(search._postings(iter([batch]), vocabulary))
    df = np.bincount(np.concatenate([b.column(2).flatten().to_numpy() for b in rows]), minlength=40)
    queries = search._Queries(pa.array([1]), np.zeros(12, np.int32), np.arange(0, 36, 3, dtype=np.int32), df, 400, 8000, 5)
    block = search._Block(rows, queries)
    full = np.zeros(400, np.int64)
    for term in queries.lists[0]:
        documents, added = block.postings(term)
        full[documents] += added
    ranked = sorted(range(400), key=lambda d: (-full[d], d))
    for least in (0, int(full[ranked[2]]), int(full[ranked[4]]), int(full.max())):
        documents, scores = block.best(queries.lists[0], 5, least)
        want = [d for d in ranked[:5] if full[d] >= max(least, 1)]
        assert sorted(documents.tolist()) == sorted(want) and all(full[documents] == scores)


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = (prose(3, 500) + " ünï-Ünï\tALPHA alpha2 ").encode() + b"z" * 300
    whole = [t for piece in search.pieces(text) for t in piece]
    monkeypatch.setattr(search, "PIECE", 64)
    assert [t for piece in search.pieces(text) for t in piece] == whole == [w.encode() for w in words(text.decode())]
