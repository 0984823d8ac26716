"""The registered queries of this subpackage and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    exact_dedup,
    licenses,
    merkle,
    mixing,
    near_dedup,
    quality,
    ranked_search,
    repeats,
    sharding,
    signature_join,
    templates,
    toxicity,
)
from .common import table
from .samples import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


# The water level in closed form: sources in the order in which they reach their cap.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS words, count(*) AS n,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, row_number() OVER (ORDER BY 3 * words / weight, source) AS place FROM s
), c AS (
  SELECT *, coalesce(sum(3 * words) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
         sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free_weight,
         sum(words) OVER () AS total
  FROM o
), l AS (
  SELECT *, CAST(total - fixed AS DOUBLE) / CAST(free_weight AS DOUBLE) AS level FROM c
), f AS (
  SELECT coalesce((SELECT level FROM l WHERE 3 * words > weight * level ORDER BY place LIMIT 1), 1e300) AS level
), t AS (
  SELECT source, weight, words, n, least(CAST(3 * words AS DOUBLE), CAST(weight AS DOUBLE) * f.level) AS target FROM s, f
), u AS (
  SELECT d.doc_id, t.source, sum(size) AS unit, any_value(words) AS words, any_value(target) AS target, any_value(weight) AS weight,
         CASE WHEN any_value(words) > 0 THEN any_value(target) / CAST(any_value(words) AS DOUBLE) ELSE 0.0::DOUBLE END AS rate,
         CAST(CAST('0x' || substr(md5('7|' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0::DOUBLE AS luck,
         CAST(ceil(any_value(n) / 2048.0) AS BIGINT) AS groups
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY d.doc_id, t.source
), g AS (
  SELECT *, CAST(floor(luck * groups) AS BIGINT) AS grp, rate - floor(rate) AS fraction FROM u
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY source, grp ORDER BY unit, luck, doc_id) AS DOUBLE) AS k,
         CAST(CAST('0x' || substr(md5('7|' || coalesce(source, '') || '|' || CAST(grp AS VARCHAR)), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0::DOUBLE AS phase
  FROM g
), p AS (
  SELECT *, CAST(floor(rate) + floor(k * fraction + phase) - floor((k - 1) * fraction + phase) AS BIGINT) AS copies FROM r
)
SELECT d.doc_id, d.source, d.size, CAST(p.words AS BIGINT) AS source_size, CAST(p.weight AS BIGINT) AS weight, p.target, p.copies,
       CAST(d.size * p.copies AS BIGINT) AS taken
FROM d JOIN p ON d.doc_id IS NOT DISTINCT FROM p.doc_id AND d.source IS NOT DISTINCT FROM p.source
"""


@query(MIX_SQL)
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


EXACT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, sha256(content) AS text_sha256
FROM n WINDOW g AS (PARTITION BY content)
"""


@query(EXACT_SQL)
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query()
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.license_scan(table(spark, folder, "documents"))
    labels = F.array_sort(F.array_union("base_labels", F.transform("spans", lambda s: s["label"])))
    return found.withColumns({"labels": F.array_join(labels, ","), "base_labels": F.array_join("base_labels", ",")}).drop("spans")


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda k: array_to_string(words[k:k + 4], ' '))) AS shingle
  FROM w WHERE len(words) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, CASE WHEN reach.other = links.a THEN links.b ELSE links.a END
  FROM reach JOIN links ON reach.other = links.a OR reach.other = links.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


@query(NEAR_SQL)
def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


@query()
def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return templates.main_text(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def judged(scores: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scores.select(
        "doc_id",
        (fold(F.col("doc_id"), folds) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@query()
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, folder, "labels"), toxicity.training_rows(4, 2))
    return judged(toxicity.toxicity_scores(docs, model), 4, 2)


@query()
def op7_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    dealt = sharding.hilbert_shards(table(spark, folder, "documents"), shards=16)
    return dealt.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query()
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    field = quality.fit_quality(docs, table(spark, folder, "labels"), quality.training_rows(5, 0))
    return judged(quality.quality_scores(docs, field), 5, 0)


@query()
def op9_remove_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(table(spark, folder, "documents"))


LEAK_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS size, unnest(list_transform(range(1, greatest(len(words) - 9, 1) + 1), lambda k: array_to_string(words[k:k + 9], ' '))) AS win
  FROM i WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM bw), dw AS (
  SELECT row, size, unnest(range(1, len(words) - size + 2)) AS k, words FROM w, sizes WHERE len(words) >= size
), dwin AS (
  SELECT row, size, k, array_to_string(words[k:k + size - 1], ' ') AS win FROM dw
), hits AS (
  SELECT row, size, k, item_id FROM dwin JOIN bw USING (size, win)
), spots AS (
  SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(k, k + size)) AS p FROM hits) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN spots USING (row) LEFT JOIN named USING (row)
"""


@query(LEAK_SQL)
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    hits = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hits.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


@query(NEAR_SQL.replace("len(words) - 4, 1", "len(words) - 2, 1").replace("words[k:k + 4]", "words[k:k + 2]").replace(">= 75 *", ">= 90 *").replace(", d.doc_id = c.component_id AS kept", ""))
def op11_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return signature_join.similar_groups(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


# crc32 by its bits; trees by levels; every row then climbs its source's tree and the tree of the subroots.
MERKLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id, source,
         list_aggregate(list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)],
                                       lambda v: CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END), 'string_agg', '') AS head,
         text,
         list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
                     lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) AS turned
  FROM documents
), leaves AS (
  SELECT row, doc_id, source, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
         CASE WHEN text IS NULL THEN NULL WHEN xor(turned, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS altered, head,
         dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree
  FROM d
), placed AS (
  SELECT row, doc_id, tree, leaf, sha256(head || CASE WHEN altered IS NULL THEN '-' ELSE strlen(altered) || ':' || altered END) AS found,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), up AS (
  SELECT tree, 0 AS level, pos, leaf AS h, n FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY tree, level, pos // 3, n
), subroots AS (
  SELECT tree, h FROM up WHERE n = 1
), top AS (
  SELECT CAST(-1 AS BIGINT) AS tree, 0 AS level, tree AS pos, h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY tree, level, pos // 3, n
), nodes AS (
  SELECT * FROM up UNION ALL SELECT * FROM top
), beside AS (
  SELECT a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.tree = b.tree AND a.level = b.level AND a.pos // 3 = b.pos // 3 GROUP BY a.tree, a.level, a.pos
), climb AS (
  SELECT row, tree, 0 AS level, pos, n, found AS h, '' AS siblings FROM placed
  UNION ALL
  SELECT row, c.tree, c.level + 1, c.pos // 3, (c.n + 2) // 3, sha256(l || c.h || r), siblings || l || r
  FROM climb c JOIN beside b ON c.tree = b.tree AND c.level = b.level AND c.pos = b.pos WHERE c.n > 1
), cross_over AS (
  SELECT row, CAST(-1 AS BIGINT) AS tree, 0 AS level, tree AS pos, (SELECT count(*) FROM subroots) AS n, h, siblings FROM climb WHERE n = 1
), rise AS (
  SELECT * FROM cross_over
  UNION ALL
  SELECT row, c.tree, c.level + 1, c.pos // 3, (c.n + 2) // 3, sha256(l || c.h || r), siblings || l || r
  FROM rise c JOIN beside b ON c.tree = b.tree AND c.level = b.level AND c.pos = b.pos WHERE c.n > 1
)
SELECT p.doc_id, p.leaf, s.h AS subroot, t.h AS root, sha256(c.siblings) AS proof_sha256, c.h AS folded_root, c.h = t.h AS verified
FROM placed p JOIN subroots s ON s.tree = p.tree JOIN rise c ON c.row = p.row AND c.n = 1 JOIN top t ON t.n = 1
"""


@query(MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    altered = F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proofs = merkle.document_proofs(table(spark, folder, "documents"), altered=altered)
    return proofs.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.siblings_hash(F.col("proof")).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


RANK_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS words
  FROM documents
), s AS (
  SELECT count(*) AS N, CAST(sum(len(words)) AS BIGINT) AS L FROM d WHERE len(words) > 0
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{0}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')) AS term
  FROM benchmark
), t AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM d) SEMI JOIN q USING (term) GROUP BY row, term
), w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * N + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s
), m AS (
  SELECT row, doc_id, 100 - 90 + (90 * len(words) * N) // L AS m FROM d, s WHERE len(words) > 0
), scores AS (
  SELECT item_id, row, any_value(doc_id) AS doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN t USING (term) JOIN w USING (term) JOIN m USING (row) GROUP BY item_id, row
), ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query(RANK_SQL)
def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
