"""Near-duplicates and components against brute force."""

import random

import numpy as np
import pytest
from cases import awkward, awkward_rows, empty, in_order, lowered, prose, spaced

from terrace.llm import hashing, near_dedup
from terrace.llm.components import connected


def shingle_set(text, width=5):
    w = spaced(lowered(text))
    size = min(width, len(w))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()


def brute(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[root(a)] = root(b)
    smallest = {}
    for k, (i, s) in enumerate(sets):
        ids = smallest.setdefault(root(k) if s else ("alone", k), [])
        if i is not None:
            ids.append(i)
    return [
        (i, len(s), min(ids, default=None), i == min(ids, default=None))
        for k, (i, s) in enumerate(sets)
        for ids in [smallest[root(k) if s else ("alone", k)]]
    ]


def edited(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in near_dedup.near_duplicates(docs, **options).select("doc_id", "n_shingles", "component_id", "kept").collect()]
    assert in_order(got) == in_order(brute(rows))


def test_awkward_rows(spark):
    got = near_dedup.near_duplicates(awkward(spark)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert in_order(tuple(r) for r in got) == in_order(brute([r[:2] for r in awkward_rows()]))
    assert near_dedup.near_duplicates(empty(spark)).count() == 0


def test_group_of_edited_copies_a_common_passage_and_chains(spark):
    rng = random.Random(4)
    rows, passage = [], prose(77, 40)
    for g in range(6):
        base = prose(g * 101, 120 + 10 * g, g + 2)
        rows += [edited(rng, base, rng.randrange(0, 9)) for _ in range(25)]
    rows += [f"{passage} {prose(g * 31, 60, 3 + g)} {passage}" for g in range(40)]
    w = prose(5, 400, 9).split(" ")
    rows += [" ".join(w[k : k + 100]) for k in range(0, 300, 7)]
    rows += [prose(k, 12, 4) for k in range(0, 20)]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_least_similarity_is_included(spark):
    base = [f"w{k}" for k in range(104)]  # 100 shingles
    near = base[:] + [f"x{k}" for k in range(33)]  # 100 shared of 133: over 75 %
    far = base[:] + [f"x{k}" for k in range(34)]  # 100 of 134: below
    check(spark, [(2, " ".join(base)), (1, " ".join(near))])
    check(spark, [(2, " ".join(base)), (1, " ".join(far))])


def test_short_texts_are_exact(spark):
    rng = random.Random(9)
    check(spark, [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 14)))) for k in range(150)])


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, 500 + k) for k in range(1, 40)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(7, 7)]
    rng.shuffle(links)
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if k != 7}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_follow_words_across_chunks(monkeypatch):
    text = (prose(3, 500) + " ünï  Ünï\tALPHA alpha ").encode() + b"z" * 300
    whole = hashing.WordHasher(near_dedup.SEPARATORS)(text)
    monkeypatch.setattr(hashing, "CHUNK", 64)
    assert np.array_equal(hashing.WordHasher(near_dedup.SEPARATORS)(text), whole)
    ids = {}
    for word, value in zip([w.lower() for w in text.split()], whole.tolist()):
        assert ids.setdefault(word, value) == value
    assert len(set(ids.values())) == len(ids) and len(whole) == len(text.split())
