"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_SPACE, hash01, saved


def word_count(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(NO_SPACE)), F.lit(0)).cast("long")


def cycling_weights(sources: DataFrame, source: str = "source", cycle: int = 3) -> DataFrame:
    """Weights 1..cycle over the sources in code-point order, null last. One row per source."""
    rank = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last()))
    return sources.select(source, ((rank - 1) % cycle + 1).cast("long").alias("weight"))


def water_filling(sources: DataFrame, share: float = 1.0, max_epochs: int = 3) -> DataFrame:
    """Targets for ``sources`` (source, weight, words).

    ``share`` of all words is split by weight. A source whose part exceeds
    ``max_epochs`` times its words is clamped there, and the excess goes to the
    others by weight, until none exceeds. Each round is one aggregate over the
    sources and clamps at least one more, so the rounds end. Adds ``target`` and
    ``source_words``. Sources without words get 0; if all are clamped, all stay at
    their caps.
    """
    cap = F.col("words") * max_epochs
    total = sources.agg(F.sum("words")).first()[0] or 0
    budget, level = share * total, None
    while True:
        clamped = F.lit(False) if level is None else cap <= F.col("weight") * F.lit(level)
        fixed, weight = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0))
        ).first()
        if not weight:
            target = cap.cast("double")
            break
        raised = (budget - fixed) / weight
        if level is not None and raised <= level:
            target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
            break
        level = raised
    return sources.select("source", "weight", F.col("words").alias("source_words"), target.alias("target"))


def mixed(
    docs: DataFrame,
    weights: DataFrame | None = None,
    share: float = 1.0,
    max_epochs: int = 3,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    group_rows: int = 2048,
) -> DataFrame:
    """How often the mix takes each document.

    A source with target/words = r takes every document floor(r) times and a seeded
    sample once more. The sample is systematic: documents of a source are dealt by a
    hash to groups of about ``group_rows``, ordered there by size, and picked at
    seeded even steps of the fraction, so each group misses its part by less than its
    largest document, and a source with a third of all rows is many groups.

    Returns one row per input row: ``id_column``, ``source`` , ``size`` (words),
    ``weight``, ``source_size``, ``target``, ``copies`` and ``taken``. ``weights``
    (source, weight) defaults to 1, 2, 3 repeating. Rows that share id and source are
    drawn together. Null text has no words; a null source is a source of its own;
    null ids share one draw per source. Other columns are ignored.
    """
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size")
    )
    rows = saved(rows, "mix-rows")
    sources = saved(rows.groupBy("source").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")), "mix-sources")
    weights = cycling_weights(sources) if weights is None else weights.select("source", "weight")
    sized = sources.alias("s").join(weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source"))).select("s.source", "words", "weight")
    targets = water_filling(saved(sized, "mix-weights"), share, max_epochs)
    plan = targets.alias("t").join(sources.alias("s"), F.col("t.source").eqNullSafe(F.col("s.source")))
    rate = F.when(F.col("source_words") > 0, F.col("target") / F.col("source_words")).otherwise(F.lit(0.0))
    plan = plan.select(
        F.col("t.source"), "weight", "source_words", "target", rate.alias("rate"), F.ceil(F.col("n") / group_rows).alias("groups")
    )
    plan = saved(plan, "mix-plan")

    units = rows.groupBy("id", "source").agg(F.sum("size").alias("unit"), F.count(F.lit(1)).alias("rows"))
    units = units.alias("u").join(plan.alias("p"), F.col("u.source").eqNullSafe(F.col("p.source")))
    luck = hash01(F.lit(seed), F.col("id"))
    units = units.select("id", "u.source", "unit", "rows", "weight", "source_words", "target", "rate", luck.alias("luck"), "groups")
    units = units.withColumn("grp", F.floor(F.col("luck") * F.col("groups")))
    fraction = F.col("rate") - F.floor("rate")
    phase = hash01(F.lit(seed), F.col("source"), F.col("grp"))
    rank = F.row_number().over(Window.partitionBy("source", "grp").orderBy("unit", "luck", "id"))
    extra = F.floor(rank * fraction + phase) - F.floor((rank - 1) * fraction + phase)
    units = units.withColumn("copies", (F.floor("rate") + extra).cast("long"))
    both = F.col("r.id").eqNullSafe(F.col("u.id")) & F.col("r.source").eqNullSafe(F.col("u.source"))
    return rows.alias("r").join(units.alias("u"), both).select(
        F.col("r.id").alias(id_column),
        F.col("r.source").alias("source"),
        F.col("r.size").alias("size"),
        "weight",
        F.col("source_words").alias("source_size"),
        "target",
        "copies",
        (F.col("r.size") * F.col("copies")).alias("taken"),
    )


def mix_rows(docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", **options) -> DataFrame:
    """``docs`` as the mix takes them: each row as many times as ``mixed`` says, columns unchanged."""
    drawn = mixed(docs, id_column=id_column, source_column=source_column, **options).where("copies > 0")
    drawn = drawn.select(F.col(id_column).alias("__id"), F.col("source").alias("__source"), F.col("copies").alias("__copies")).distinct()
    same = docs[id_column].eqNullSafe(drawn["__id"]) & docs[source_column].eqNullSafe(drawn["__source"])
    repeated = docs.join(drawn, same).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return repeated.select(*[docs[c] for c in docs.columns])
