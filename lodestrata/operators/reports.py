"""Nested reports as JSON texts, and metrics observed while a table is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .scoring import age_text


def _round(c: str, places: int) -> Column:
    return F.round(F.col(c) + 1e-9, places).alias(c)


def lineage_json(votes: DataFrame, traces: DataFrame) -> DataFrame:
    """``entity_id, lineage``: one JSON text an entity: its fields with winner, confidence and consensus, and each source's part in them."""
    t = traces.groupBy("entity_id", "field_name").agg(F.sort_array(F.collect_list(F.struct("assertion_id", "role", _round("quality", 4), "passed"))).alias("sources"))
    f = votes.join(t, ["entity_id", "field_name"], "left").select("entity_id", F.struct("field_name", "winner", _round("confidence", 4), "method", "contested", _round("consensus", 3), "sources").alias("f"))
    return f.groupBy("entity_id").agg(F.to_json(F.struct(F.sort_array(F.collect_list("f")).alias("fields"))).alias("lineage"))


def quality_json(scored: DataFrame, dimensions: list[str]) -> DataFrame:
    """``entity_id, report``: score and grade with every dimension, as JSON."""
    return scored.select("entity_id", F.to_json(F.struct(F.round(F.col("score") + 1e-9, 2).alias("score"), "grade", "exportable", F.struct(*[_round(d, 1) for d in dimensions]).alias("dimensions"))).alias("report"))


def freshness_json(assessed: DataFrame, key: str) -> DataFrame:
    """``key, report``: age in words, score, level and whether a new crawl is due, as JSON."""
    due = F.col("level").isin("stale", "critical")
    return assessed.select(key, F.to_json(F.struct(age_text(F.col("age")).alias("age"), _round("fresh_score", 1), _round("priority", 3), "level", due.alias("recrawl"))).alias("report"))


def level_counts(assessed: DataFrame, kind: str = "record_type") -> DataFrame:
    """``kind, fresh, aging, stale, critical, due``: entities by level, and whether any is stale or critical."""
    n = lambda x: F.count_if(F.col("level") == x).alias(x)
    return assessed.groupBy(kind).agg(*[n(x) for x in ("fresh", "aging", "stale", "critical")]).withColumn("due", F.col("stale") + F.col("critical") > 0)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counters and gauges that are taken while it is read once; ``observation.get`` holds them afterwards."""
    o = Observation(name)
    return df.observe(o, *[c.alias(k) for k, c in metrics.items()]), o


def labelled(df: DataFrame, labels: list[str], **metrics: Column) -> DataFrame:
    """Counters by label, in long form: ``labels, metric, value``."""
    d = df.groupBy(*labels).agg(*[c.cast("double").alias(k) for k, c in metrics.items()])
    return d.unpivot(labels, list(metrics), "metric", "value")
