"""Exact dedup, decontamination, sharding and mixing."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from cases import awkward, awkward_rows, empty, in_order, prose, spaced, words
from pyspark.sql import functions as F

from terrace.llm import decontaminate, exact_dedup, mixing, sharding


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.length(c).cast("string").cast("binary"), lambda c: F.lit(b"x")])
def test_exact_groups_even_when_digests_clash(spark, digest):
    found = exact_dedup.exact_groups(awkward(spark), digest=digest, salts=2)
    groups = defaultdict(list)
    for i, t, *_ in awkward_rows():
        groups[normal(t)].append(i)
    want = []
    for i, t, *_ in awkward_rows():
        ids = [k for k in groups[normal(t)] if k is not None]
        keep = min(ids) if ids else None
        want.append((i, keep, len(groups[normal(t)]), i == keep))
    got = [tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept").collect()]
    assert in_order(got) == in_order(want)
    assert exact_dedup.exact_groups(empty(spark), digest=digest).count() == 0


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, words string")


def brute_hits(text, items, n=10):
    w, hit, names = words(text), set(), set()
    for item, other in items:
        b = words(other)
        size = min(n, len(b))
        windows = {tuple(b[k : k + size]) for k in range(len(b) - size + 1)} if b else set()
        for k in range(len(w) - size + 1):
            if tuple(w[k : k + size]) in windows:
                hit |= set(range(k, k + size))
                if item is not None:
                    names.add(str(item))
    return len(w), sorted(hit), sorted(names)


@pytest.mark.parametrize("limit", [100_000, 0])
def test_contaminated_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
    items = [(1, prose(8, 14)), (2, "One, two"), (3, None), (4, "..."), (10, prose(3, 25)), (None, "ünï"), (5, prose(3, 25))]
    found = decontaminate.contaminated(awkward(spark), benchmark(spark, [(i, t, "x") for i, t in items]))
    got = [(r["doc_id"], r["n_words"], r["hits"], r["items"]) for r in found.collect()]
    want = [(i, *brute_hits(t, items)) for i, t, *_ in awkward_rows()]
    assert in_order(got) == in_order(want)
    assert any(w[2] for w in want)


def test_small_bitmap_only_costs_candidates(spark):
    items = [(10, prose(3, 25))]
    table = benchmark(spark, [(i, t, "x") for i, t in items])
    found = decontaminate.contaminated(awkward(spark), table, bits=6)
    assert in_order((r["doc_id"], r["hits"]) for r in found.collect()) == in_order(
        (i, brute_hits(t, items)[1]) for i, t, *_ in awkward_rows()
    )


def test_windows_beyond_one_pass(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_WINDOWS", 7)
    items = [(10, prose(3, 25)), (2, "One, two"), (1, prose(8, 14))]
    found = decontaminate.contaminated(awkward(spark), benchmark(spark, [(i, t, "x") for i, t in items]))
    got = [(r["doc_id"], r["n_words"], r["hits"], r["items"]) for r in found.collect()]
    assert in_order(got) == in_order((i, *brute_hits(t, items)) for i, t, *_ in awkward_rows())


def test_a_full_pass_lets_few_other_windows_through(spark):
    windows = decontaminate.PASS_WINDOWS
    bits = decontaminate.set_bits(windows)
    assert bits == 24 and decontaminate.set_bits(1) == 20
    bitmap = decontaminate.hash_set(spark.range(windows).select(F.xxhash64("id").alias("hash")), bits)
    value = F.xxhash64("id")
    table = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")
    others = spark.range(windows, windows + 20_000).where(decontaminate.in_set(table, bits, value)).count()
    assert others < 0.05 * 20_000
    assert spark.range(5_000).where(decontaminate.in_set(table, bits, value)).count() == 5_000


def test_decontaminated_drops_documents_or_spans(spark):
    docs, table = awkward(spark), benchmark(spark, [(1, prose(3, 12), "x"), (2, "one two", "y")])
    kept = decontaminate.decontaminated(docs, table)
    assert kept.columns == docs.columns
    bad = {i for i, t, *_ in awkward_rows() if brute_hits(t, [(1, prose(3, 12)), (2, "one two")])[1]}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, *_ in awkward_rows() if i not in bad)
    cut = decontaminate.decontaminated(docs, table, remove="spans").where("doc_id = 3").first()
    assert words(cut["text"]) == words(prose(3, 60) + " tail")[12:]
    odd = decontaminate.decontaminated(docs, table, remove="spans").where("doc_id = 8").first()
    assert odd["text"] == ""
    assert decontaminate.decontaminated(docs, benchmark(spark, [])).count() == docs.count()
    assert decontaminate.contaminated(empty(spark), table).count() == 0


def check_shards(rows, shards, docs):
    assert in_order((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == in_order(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs
    )
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    order = [r["cell"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order == sorted(order)


@pytest.mark.parametrize("shards,run_rows", [(16, 2), (5, 2000), (40, 1)])
def test_shards_are_even_gapless_runs_of_the_curve(spark, shards, run_rows):
    check_shards(sharding.hilbert_shards(awkward(spark), shards, run_rows=run_rows).collect(), shards, awkward_rows())
    assert sharding.hilbert_shards(empty(spark)).count() == 0


def test_copies_of_a_text_share_a_shard_and_a_hot_id_no_long_run(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 7)
    rows = [(k, f"text {k // 4}", "en", "a", "x") for k in range(2000)]
    rows += [(5, f"hot {k % 3}", "en", "a", "x") for k in range(500)] + [(None, None, "en", "a", "x")] * 500
    rows += [(9000 + k, "one text", "en", "a", "x") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, x string")
    found = sharding.hilbert_shards(docs, 8, run_rows=50).collect()
    check_shards(found, 8, rows)
    homes = {}
    for r in found:
        homes.setdefault((r["cell"], r["text_crc32"], r["doc_id"] is not None and r["doc_id"] < 2000), set()).add(r["shard"])
    assert sum(len(h) > 1 for h in homes.values()) <= 7 + 3
    place = {(r["shard"], r["slot"]): (r["cell"], r["text_crc32"]) for r in found}
    runs = [place[k] for k in sorted(place)]
    assert sum(a != b for a, b in zip(runs, runs[1:])) + 1 == len(set(runs))  # equal texts of a cell stand together


def test_hilbert_neighbours_touch():
    for bits, dims in ((2, 2), (3, 3), (4, 3)):
        side, index = 1 << bits, sharding.hilbert_indexes(bits, dims)
        assert sorted(index) == list(range(side**dims))
        cells = sorted(range(len(index)), key=index.__getitem__)
        spot = [[(c >> bits * (dims - 1 - d)) & side - 1 for d in range(dims)] for c in cells]
        assert all(sum(abs(x - y) for x, y in zip(a, b)) == 1 for a, b in zip(spot, spot[1:]))


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = awkward(spark).withColumn("shard", F.lit("clash"))
    sharding.write_shards(docs, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert in_order((r["doc_id"], r["text"]) for r in back.collect()) == in_order((i, t) for i, t, *_ in awkward_rows())


def brute_targets(sources, epochs=3):
    """Round by round: clamp what exceeds its cap, share the rest by weight."""
    total, clamped = sum(w for w, _ in sources.values()), {}
    while True:
        rest = {s: v for s, v in sources.items() if s not in clamped}
        free = sum(weight for _, weight in rest.values())
        budget = total - sum(clamped.values())
        over = {s for s, (w, weight) in rest.items() if epochs * w < budget * weight / free} if free else set()
        if not over:
            return {**clamped, **{s: budget * weight / free for s, (_, weight) in rest.items()}}
        clamped |= {s: epochs * sources[s][0] for s in over}


def test_mix_meets_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7919 % 97)), "en", "abcdefg"[min(6, i * i % 31 % 9)], 0, "", 0, 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, target string, weight long, rate int")
    found = mixing.mixed(docs, group_rows=100).collect()
    sizes = Counter()
    for i, t, _, s, *_ in rows:
        sizes[s] += len(spaced(t))
    want = brute_targets({s: (sizes[s], k % 3 + 1) for k, s in enumerate(sorted(sizes))})
    taken = Counter()
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["size"] * r["copies"]
        taken[r["source"]] += r["taken"]
    assert len(found) == len(rows)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.05 * want[s] + 97
    again = mixing.mixed(docs, group_rows=100).collect()
    assert in_order((r["doc_id"], r["copies"]) for r in found) == in_order((r["doc_id"], r["copies"]) for r in again)
    other = mixing.mixed(docs, group_rows=100, seed=8).collect()
    assert in_order((r["doc_id"], r["copies"]) for r in found) != in_order((r["doc_id"], r["copies"]) for r in other)


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark)
    found = mixing.mixed(docs)
    assert in_order((r["doc_id"], r["size"]) for r in found.collect()) == in_order((i, len(spaced(t))) for i, t, *_ in awkward_rows())
    copies = Counter()
    for r in found.collect():
        copies[r["doc_id"], r["source"]] = r["copies"]
    repeated = mixing.mix_rows(docs)
    assert repeated.columns == docs.columns
    got = Counter((r["doc_id"], r["source"]) for r in repeated.collect())
    rows = Counter((i, s) for i, _, _, s, *_ in awkward_rows())
    assert got == Counter({k: copies[k] * n for k, n in rows.items() if copies[k]})
    assert mixing.mixed(empty(spark)).count() == 0
    blank = docs.withColumn("text", F.lit(None).cast("string"))
    assert {r["taken"] for r in mixing.mixed(blank).collect()} == {0}


def test_all_sources_at_their_caps(spark):
    sources = spark.createDataFrame([("a", 2, 10), ("b", 1, 0)], "source string, weight long, words long")
    found = {r["source"]: r["target"] for r in mixing.water_filling(sources, share=9.0).collect()}
    assert found == {"a": 30.0, "b": 0.0}


def test_text_hash_is_lower_hex(spark):
    row = exact_dedup.exact_groups(awkward(spark)).where("doc_id = 8").first()
    assert row["digest"].hex() == hashlib.sha256(b"One TWO").hexdigest()


def test_copies_are_combined_before_and_after_a_salted_shuffle(spark):
    rows = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id) END AS content")
    rows = rows.withColumn("digest", exact_dedup.sha256(F.col("content")))
    winners = exact_dedup._winners(rows, 8)
    text = winners._jdf.queryExecution().sparkPlan().toString()
    kinds = [line.strip(" +-:") for line in winners._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line or "Aggregate" in line]
    kinds = [k for k in kinds if k.startswith(("Exchange", "HashAggregate", "ObjectHash", "SortAgg"))]
    steps = [re.split(r"[ (]", k)[0] for k in kinds]
    assert steps == ["HashAggregate", "Exchange", "HashAggregate", "HashAggregate", "Exchange", "HashAggregate"] and "Join" not in text
    assert "_groupingexpression" in kinds[4] and "content" in kinds[4]
    salted = rows.where("content = 'hot'").groupBy(F.pmod(F.xxhash64("id"), F.lit(8))).count().count()
    assert salted == 8 and [tuple(r) for r in winners.where("n > 1").select("keep", "n").collect()] == [(0, 1000)]


def test_texts_beyond_the_broadcast_bound_give_the_same_groups(spark):
    some = exact_dedup.exact_groups(awkward(spark)).collect()
    assert in_order(map(tuple, exact_dedup.exact_groups(awkward(spark), broadcast_digests=0).collect())) == in_order(map(tuple, some))
