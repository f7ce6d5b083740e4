"""Evidence-weighted voting: rival assertions of one field become one value with a confidence and an audit trail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Credibility of well-known sources; any other source has FALLBACK.
CREDIBILITY = {"crunchbase": 0.95, "pitchbook": 0.93, "linkedin": 0.90, "techcrunch": 0.88, "producthunt": 0.85, "github": 0.92, "arxiv": 0.95, "ycombinator": 0.90}
FALLBACK = 0.75
#: Added before rounding, so that halves go up whatever the last bit of a sum of doubles is.
TIES = 1e-9


def unit(c: Column) -> Column:
    """A score on 0..1: missing or NaN is 0, above 1 it is a percentage."""
    x = F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)
    return F.when(x > 1, x / 100).otherwise(x)


def recency(fetched: Column, now: str, half_life: float = 30.0) -> Column:
    """2^(-age/half_life), at least 0.1; 1 for times not past; 0.1 where the time is unknown."""
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(fetched.cast("timestamp"))) / F.lit(86400e6)
    return F.when(age.isNull(), F.lit(0.1)).when(age <= 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.1), F.pow(F.lit(2.0), -age / half_life)))


def normalized_value(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(c)), r"\s+", " ")


def score_assertions(rows: DataFrame, now: str, credibility: DataFrame | None = None, half_life: float = 30.0) -> DataFrame:
    """``rows`` plus g, t, r, c and score = g·t·r·c. ``credibility``: (source_key, credibility); else the fixed table."""
    key = F.lower(F.trim("source_name"))
    if credibility is None:
        table = F.create_map(*[F.lit(x) for kv in CREDIBILITY.items() for x in kv])
        d = rows.withColumn("c", F.coalesce(table[key], F.lit(FALLBACK)))
    else:
        d = rows.withColumn("source_key", key).join(credibility, "source_key", "left").withColumn("c", F.coalesce("credibility", F.lit(FALLBACK))).drop("credibility", "source_key")
    d = d.withColumn("g", unit(F.col("grounding_score"))).withColumn("t", unit(F.col("trust_score"))).withColumn("r", recency(F.col("fetched_at"), now, half_life))
    return d.withColumn("score", F.col("g") * F.col("t") * F.col("r") * F.col("c"))


def vote_fields(scored: DataFrame) -> DataFrame:
    """One row per entity and field: winner, confidence, method, contested, consensus, n, n_values.

    Two aggregations, first by normalized value, so that a field with very many assertions is never in one task. Ties go
    to the group, and in it to the assertion, with the smallest position.
    """
    d = scored.where("value IS NOT NULL").withColumn("vk", normalized_value(F.col("value")))
    order = F.struct(F.col("pos"), F.col("assertion_id"))
    groups = d.groupBy("entity_id", "field_name", "vk").agg(
        F.round(F.sum("score"), 9).alias("s"), F.count(F.lit(1)).alias("k"), F.min(order).alias("first"),
        F.min(F.struct((-F.round("score", 9)).alias("x"), "pos", "assertion_id", "value", "score", "g", "t")).alias("best"),
    )
    fields = groups.groupBy("entity_id", "field_name").agg(
        F.sum("k").alias("n"), F.count(F.lit(1)).alias("n_values"), F.sum("s").alias("total"),
        F.min(F.struct((-F.col("s")).alias("x"), "first", "s", "k", "best")).alias("w"),
    )
    share = F.when(F.col("total") > 0, F.col("w.s") / F.col("total")).otherwise(0.0)
    single = F.col("n") == 1
    conf = F.when(single, F.least(F.col("w.best.g") * F.col("w.best.t"), F.lit(0.7))).otherwise(F.least(F.lit(1.0), share * (0.5 + 0.5 * F.col("w.best.score"))))
    method = F.when(single, "single_source").when(F.col("n_values") == 1, "unanimous").when(F.col("w.k") > F.col("n") / 2, "majority_vote").otherwise("quality_winner")
    return fields.select(
        "entity_id", "field_name", F.col("w.best.value").alias("winner"), F.round(conf + TIES, 4).alias("confidence"), method.alias("method"), (F.col("n_values") > 1).alias("contested"),
        F.round(F.col("w.k") / F.col("n") + TIES, 3).alias("consensus"), "n", "n_values",
    )


def vote_report(votes: DataFrame) -> DataFrame:
    """One row per entity: fields, contested and unanimous fields, overall confidence."""
    return votes.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("fields"), F.count_if("contested").alias("contested_fields"), F.count_if(~F.col("contested")).alias("unanimous_fields"), F.round(F.avg("confidence") + TIES, 4).alias("overall_confidence")
    )
