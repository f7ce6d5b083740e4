"""Quality, freshness and confidence scores as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .voting import TIES

# Weights of the quality dimensions, days an entity of a type stays fresh.
WEIGHTS = {"source_diversity": 0.15, "grounding": 0.25, "consensus": 0.25, "trust": 0.15, "completeness": 0.10, "freshness": 0.10}
FRESH_DAYS = {"STARTUP": 14, "PRODUCT": 30, "NEWS": 1, "NEWS_SIGNAL": 1, "JOB": 7, "PAPER": 90}
FRESH_FALLBACK = 30


def age_days(ts: Column, now: str) -> Column:
    return (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / F.lit(86400e6)


def source_diversity(n: Column) -> Column:
    return F.when(n <= 0, 0.0).when(n == 1, 40.0).when(n == 2, 70.0).otherwise(F.least(F.lit(100.0), 85 + 15 * F.log2(n - 2)))


def percent(x: Column) -> Column:
    """A mean on 0..1 or 0..100 as 0..100."""
    return F.when(x.isNull(), 0.0).when(x <= 1, x * 100).otherwise(F.least(F.lit(100.0), x))


def completeness(present: Column, required: Column) -> Column:
    return F.when(required <= 0, 100.0).otherwise(F.least(F.lit(100.0), present / required * 100))


def freshness(age: Column) -> Column:
    return F.when(age.isNull(), 0.0).when(age <= 0, 100.0).otherwise(F.greatest(F.lit(10.0), 100 * F.pow(F.lit(2.0), -age / 30)))


def grade(score: Column) -> Column:
    return F.when(score >= 90, "A").when(score >= 75, "B").when(score >= 60, "C").when(score >= 40, "D").otherwise("F")


def quality(df: DataFrame) -> DataFrame:
    """``df`` (with a column for each dimension, 0..100) plus score, grade, exportable, needs_review, needs_recrawl, recommendations."""
    total = sum((F.col(k) * w for k, w in WEIGHTS.items()), F.lit(0.0))
    low = F.filter(F.array(*[F.when(F.col(k) < 40, F.lit(k)) for k in WEIGHTS]), lambda x: x.isNotNull())
    d = df.withColumn("score", F.round(total + TIES, 4))
    return (
        d.withColumn("grade", grade(F.col("score")))
        .withColumn("exportable", F.col("score") >= 60)
        .withColumn("needs_review", (F.col("score") >= 60) & (F.col("score") < 75))
        .withColumn("needs_recrawl", (F.col("source_diversity") < 40) | (F.col("freshness") < 40) | (F.col("grounding") < 40))
        .withColumn("recommendations", F.when(F.size(low) > 0, F.concat_ws(",", low)).when(F.col("score") >= 90, "excellent").otherwise(""))
    )


def age_text(age: Column) -> Column:
    """today, 1 day, n days, months, years."""
    d = F.floor(age)
    return (
        F.when(age.isNull(), "unknown").when(d <= 0, "today").when(d == 1, "1 day").when(d < 30, F.concat(d.cast("string"), F.lit(" days")))
        .when(d < 365, F.concat(F.floor(d / 30).cast("string"), F.lit(" months"))).otherwise(F.concat(F.floor(d / 365).cast("string"), F.lit(" years")))
    )


def assess_freshness(df: DataFrame, now: str, ts: str = "fetched_at", kind: str = "record_type", policies: dict[str, int] | None = None) -> DataFrame:
    """``df`` plus max_days, age, fresh_score, priority and level (fresh, aging, stale, critical). Without a time: critical."""
    p = policies or FRESH_DAYS
    table = F.create_map(*[F.lit(x) for k, v in p.items() for x in (k, float(v))])
    d = df.withColumn("max_days", F.coalesce(table[F.col(kind)], F.lit(float(FRESH_FALLBACK)))).withColumn("age", age_days(F.col(ts), now))
    d = d.withColumn("fresh_score", F.when(F.col("age").isNull(), 0.0).when(F.col("age") <= 0, 100.0).otherwise(100 * F.pow(F.lit(2.0), -F.col("age") / F.col("max_days"))))
    d = d.withColumn("priority", F.when(F.col("age").isNull(), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("age") / F.col("max_days")))))
    r = F.col("age") / F.col("max_days")
    return d.withColumn("level", F.when(r.isNull() | (r >= 2), "critical").when(r >= 1, "stale").when(r >= 0.7, "aging").otherwise("fresh"))


def recrawl_queue(assessed: DataFrame, key: str, top: int = 20) -> DataFrame:
    """The ``top`` most urgent entities that are not fresh; a report, so the limit is the feature."""
    return assessed.where("level <> 'fresh'").orderBy(F.desc("priority"), F.asc(key)).limit(top)


def entity_confidence(res: Column, ground: Column, sources: Column, schema_valid: Column, days: Column, seed: Column) -> Column:
    rec = F.when(days <= 7, 1.0).when(days <= 30, 0.8).when(days <= 90, 0.5).otherwise(0.2)
    x = 0.3 * F.least(res, F.lit(1.0)) + 0.3 * F.least(ground, F.lit(1.0)) + 0.2 * F.least(sources / 5, F.lit(1.0)) + 0.1 * schema_valid.cast("double") + 0.1 * rec
    return F.when(seed, 1.0).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) + TIES, 4))


def edge_confidence(a: Column, b: Column, extraction: Column, grounded: Column) -> Column:
    return F.round(0.4 * F.least(a, b) + 0.4 * extraction + 0.2 * F.when(grounded, 1.0).otherwise(0.5) + TIES, 4)


def budget_level(used: Column, budget: float) -> Column:
    pct = used / F.lit(budget) * 100 if budget else F.lit(0.0)
    return F.when(pct >= 100, "halt").when(pct >= 90, "saving").when(pct >= 80, "warn").otherwise("ok")
