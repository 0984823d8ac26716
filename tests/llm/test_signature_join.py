"""The n-gram join and its trees against all pairs."""

import random

import numpy as np
import pytest
from cases import awkward, awkward_rows, empty, in_order, lowered, prose, spaced

from terrace.llm import signature_join as join


def shingle_set(text, width=3):
    w = spaced(lowered(text))
    size = min(width, len(w))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()


def brute(rows, percent=90):
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if label[a] != label[b] and x and y and 100 * len(x & y) >= percent * len(x | y):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if k == old else k for k in label]
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[label[k]] = min(i, ids.get(label[k], i))
    return in_order((i, len(sets[k]), ids.get(label[k]) if sets[k] else i) for k, (i, _) in enumerate(rows))


def got(df):
    return in_order(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect())


def edited(rng, text, edits):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"edit{rng.randrange(10**6)}"
    return " ".join(w)


def groups(seed):
    """Near copies around the threshold, chains, a passage that many texts share, short texts, exact copies."""
    rng = random.Random(seed)
    rows, passage = [], prose(77, 40)
    for g in range(5):
        base = prose(g * 101, 150 + 30 * g, g + 2)
        rows += [edited(rng, base, rng.randrange(0, 7)) for _ in range(25)]
    rows += [f"{passage} {prose(g * 31, 60, 3 + g)} {passage}" for g in range(40)]
    w = prose(5, 500, 9).split(" ")
    rows += [" ".join(w[k : k + 200]) for k in range(0, 300, 6)]
    rows += [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 14))) for _ in range(60)]
    rows += [rows[3]] * 20
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("limits", [{}, {"block_sets": 8, "block_tokens": 3000}, {"block_sets": 1, "block_tokens": 300, "share": 0.9}])
def test_groups_chains_and_common_passages(spark, limits):
    rows = groups(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(join.similar_groups(docs, **limits)) == brute(rows)


def test_awkward_rows(spark):
    assert got(join.similar_groups(awkward(spark))) == brute([r[:2] for r in awkward_rows()])
    assert join.similar_groups(empty(spark)).count() == 0


def test_least_similarity_is_included(spark):
    base = [f"w{k}" for k in range(92)]  # 90 shingles
    near, far = base + [f"x{k}" for k in range(10)], base + [f"x{k}" for k in range(11)]  # 90 of 100, of 101
    for other in (near, far):
        rows = [(2, " ".join(base)), (1, " ".join(other))]
        assert got(join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def token_sets(seed, count):
    rng = np.random.default_rng(seed)
    bases = [rng.choice(10**6, 120, replace=False) for _ in range(6)]
    out = []
    for k in range(count):
        base = bases[k % 6]
        kept = base[rng.random(120) > rng.choice([0.0, 0.02, 0.06, 0.1])]
        out.append(np.unique(np.concatenate([kept, rng.choice(10**6, rng.integers(0, 8))])))
    return out


def components(count, links):
    forest = join.Forest(range(count))
    for a, b in links:
        forest.join(a, b)
    return [forest.root(k) for k in range(count)]


@pytest.mark.parametrize("bits", [1 << 14, 64])
def test_walks_find_the_components_of_all_pairs(monkeypatch, bits):
    monkeypatch.setattr(join, "BITS", bits)
    sets = token_sets(1, 400)
    sizes = np.array([len(s) for s in sets])
    similar = [
        (a, b) for a in range(400) for b in range(a) if 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= 90 * (sizes[a] + sizes[b] - both)
    ]
    want = components(400, similar)
    order = join.arranged(sets, sizes)
    whole = join.Walk(sets, sizes, list(range(400)), 90)
    whole.join(order)
    assert components(400, whole.links) == want and set(map(frozenset, whole.links)) <= set(map(frozenset, similar))
    assert whole.exact == (bits > 64)
    across = join.Walk(sets, sizes, list(range(400)), 90)
    across.join(order[:30]), across.join(order[30:]), across.join(order[:30], order[30:])
    assert components(400, across.links) == want


def test_unlike_nodes_are_dropped_above_the_leaves():
    """Two groups of near copies under one root: no pair of nodes across them can be similar, every pair inside can."""
    bases = [np.arange(100), np.arange(60, 160)]
    sets = [np.delete(base, k % 50) for base in bases for k in range(64)]
    walk = join.Walk(sets, np.array([len(s) for s in sets]), list(range(128)), 90)
    tree = walk.tree(np.arange(128))
    level = len(tree.levels) - 2
    fits, most = tree.possible(level, np.array([0, 0, 1]), tree, np.array([0, 1, 1]), 90)
    assert len(tree.levels[level][0]) == 2 and fits.tolist() == [True, False, True] and most[1] == 40


@pytest.mark.parametrize("percent", [50, 75, 90, 97, 100])
def test_size_ranges_bound_the_difference_of_similar_sets(percent):
    ends, differ = join.size_ranges(percent)
    for a in range(1, 200):
        of_a = np.searchsorted(ends, a)
        for b in range(a, 100 * a // percent + 1):
            least = join.least_shared(a, b, percent)
            if least <= a:
                assert a + b - 2 * least <= differ[of_a] and np.searchsorted(ends, b) - of_a in (0, 1)


@pytest.mark.parametrize("deals", [1, 3])
@pytest.mark.parametrize("high", [1 << 12, 1 << 62])  # the lower ones lie in one part of the first deal
def test_sets_as_unlike_as_allowed_share_a_key(monkeypatch, deals, high):
    monkeypatch.setattr(join, "DEALS", deals)
    rng = np.random.default_rng(5)
    for a in [*range(9, 60), 75, 76, 105, 300, 1500]:
        for b in {a, min(a + 1, 10 * a // 9), 10 * a // 9}:
            both = int(join.least_shared(a, b, 90))
            tokens = rng.choice(high, a + b - both, replace=False) - rng.integers(0, 2) * (high // 2)
            pair = [np.unique(tokens[:a]), np.unique(np.concatenate([tokens[:both], tokens[a:]]))]
            assert [len(s) for s in pair] == [a, b]
            assert both > a or np.array_equal(*pair) or np.intersect1d(*[join.part_keys(s, 90) for s in pair]).size


def test_texts_that_only_share_shingles_make_no_lists(spark, monkeypatch):
    """Every shingle stands in several texts, yet few but the two near copies are listed together."""
    held, stored = [], join.saved
    monkeypatch.setattr(join, "saved", lambda df, name: held.append((name, stored(df, name))) or held[-1][1])
    monkeypatch.setattr(join, "BROADCAST_IDS", 0)
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("abcdefghijkl") for _ in range(150))) for k in range(200)]
    rows.append((200, f"{rows[7][1]} z"))
    assert got(join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    listed = [df.select("node").distinct().count() for name, df in held if name in ("shared", "contenders", "members")]
    assert listed and 2 <= max(listed) <= 20
