"""Suffix arrays and repeat removal against brute force."""

import hashlib
import random
from collections import Counter

import pytest
from cases import awkward, awkward_rows, empty, in_order, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import repeats
from terrace.llm.suffixes import suffix_array


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 97, 98, 99, 255]), max_size=70).map(bytes), st.integers(1, 3))
def test_suffix_array(text, times):
    text *= times
    assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute(rows, size):
    data = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(b[k : k + size] for _, b in data for k in range(len(b) - size + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if counts[b[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        spans = bytes(gone).count(b"\0\1") + (gone[:1] == b"\1")
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def check(spark, rows, size, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in repeats.without_repeats(docs, size, **options).collect()]
    assert in_order(got) == in_order(brute(rows, size))


def mixture(seed):
    rng = random.Random(seed)
    passage, rows = prose(5, 30, 3), []
    for k in range(30):
        text = prose(k * 37, 50, k % 11 + 2)
        if k % 3 == 0:
            at = rng.randrange(len(text))
            cut = rng.randrange(0, 40)
            text = text[:at] + passage[cut : cut + rng.randrange(60, 200)] + text[at:]
        if k % 5 == 0:
            text = text + " " + text[: rng.randrange(len(text))]
        rows.append(text)
    base = prose(900, 90, 5)
    for k in range(8):
        w = base.split(" ")
        w[rng.randrange(90)] = "edit" + str(k)
        rows.append(" ".join(w))
    rows += ["Ha " * 100, "a" * 500, "Ha " * 40, rows[0], "é" * 150, None, ""]
    return list(enumerate(rows))


@pytest.mark.parametrize("group_rows", [2048, 1, 3])
def test_all_ways_agree_with_brute_force(spark, group_rows):
    check(spark, mixture(group_rows), 100, group_rows=group_rows)


def test_awkward_rows(spark):
    got = [tuple(r) for r in repeats.without_repeats(awkward(spark), 100).collect()]
    assert in_order(got) == in_order(brute([r[:2] for r in awkward_rows()], 100))
    assert repeats.without_repeats(empty(spark)).count() == 0


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1000)
    check(spark, mixture(5), 100)


def test_windows_of_a_text_have_one_anchor_each():
    text = prose(1, 800).encode()
    _, first, last, at = repeats.anchors(text, 200)
    assert first[0] == 0 and last[-1] == len(text) - 200
    assert (first[1:] == last[:-1] + 1).all()
    assert ((at >= last) & (at + repeats.GRAM <= first + 200)).all()
