"""The pipeline's stages on small tables, each held against brute force on its own input."""

from collections import Counter

import pytest
from cases import awkward, empty, in_order
from test_native import brute_hits, check_shards
from test_near_dedup import brute

import corpus_pipeline
from terrace.llm import mixing, quality
from terrace.llm.common import saved, table

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["classify", "deduplicate", "decontaminate_documents", "mix", "shard"]


def test_run_matches_brute_force_stage_by_stage(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        out = saved(stage(spark, docs, FOLDER), "test")
        after = [tuple(r) for r in out.collect()]
        if name == "sharding":
            check_shards(out.collect(), corpus_pipeline.SHARDS, before)
            assert in_order(after) == in_order(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect())
            break
        assert out.columns == columns and after
        if name == "quality classifier":
            field = quality.fit_quality(docs, table(spark, FOLDER, "labels"), quality.training_rows())
            want = [r for r in before if field.score((r[1] or "").encode()) >= 0.3]
        elif name == "near-duplicates":
            kept = {i for i, _, _, keep in brute([r[:2] for r in before]) if keep}
            want = [r for r in before if r[0] in kept]
        elif name == "benchmark decontamination":
            items = [(r["item_id"], r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
            want = [r for r in before if not brute_hits(r[1], items)[1]]
        else:
            copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(docs).collect()}
            want = [r for r in before for _ in range(copies[r[0]])]
            assert max(Counter(r[0] for r in after).values()) <= 3
        assert in_order(after) == in_order(want)
        assert name == "source mixing" or len(after) < len(before)
        docs = out


@pytest.mark.parametrize("make", [awkward, empty])
def test_stages_take_awkward_and_empty_tables(spark, make):
    docs = make(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, docs, FOLDER), "test")
        if name != "sharding":
            assert out.columns == docs.columns
        docs = out
    assert make is awkward or docs.count() == 0
