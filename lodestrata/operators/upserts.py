"""Deduplication, and upserts as folds over the rows in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order`` (nulls last); an aggregation over a struct, so a hot key is pre-aggregated."""
    rest = [c for c in df.columns if c not in keys]
    lead = [x for i, o in enumerate(order) for x in (F.col(o).isNull().alias(f"n{i}"), F.col(o).alias(f"o{i}"))]
    return df.groupBy(*keys).agg(F.min(F.struct(*lead, F.struct(*rest).alias("row"))).alias("k")).select(*keys, "k.row.*").select(*df.columns)


def last_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key by ``order`` (nulls first)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.struct(*rest).alias("row"))).alias("k")).select(*keys, "k.row.*").select(*df.columns)


def url_day_dedup(df: DataFrame, hash_col: Column, ts: str, order: str) -> DataFrame:
    """``df`` plus dup_key, day and is_duplicate: seen before on the same UTC day with the same hash and source."""
    d = df.withColumn("dup_key", hash_col).withColumn("day", F.to_date(ts))
    first = d.groupBy("dup_key", "source_name", "day").agg(F.min(order).alias("first_seen"))
    return d.join(first, ["dup_key", "source_name", "day"]).withColumn("is_duplicate", F.col(order) > F.col("first_seen")).drop("first_seen")


def unseen(df: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(seen.select(*keys).distinct(), keys, "left_anti")


def upsert_fold(df: DataFrame, key: str, order: list[str], keep_first: list[str], replace: list[str]) -> DataFrame:
    """One row per key: first values of ``keep_first``, last values of ``replace``, ``source_count`` and last position."""
    o = F.struct(*order)
    return df.groupBy(key).agg(*[F.min_by(c, o).alias(c) for c in keep_first], *[F.max_by(c, o).alias(c) for c in replace], F.count(F.lit(1)).alias("source_count"))


def mark_exported(entities: DataFrame, exported: DataFrame, key: str) -> DataFrame:
    e = exported.groupBy(key).agg(F.max("exported_at").alias("new_exported_at"))
    return entities.join(e, key, "left").withColumn("exported_at", F.coalesce("new_exported_at", "exported_at")).drop("new_exported_at")


def promote_seeds(df: DataFrame) -> DataFrame:
    """Entities that become seeds: known, confident, with several sources, and no seed yet."""
    return df.where("method <> 'unresolved' AND confidence >= 0.95 AND source_count >= 3 AND NOT is_seed")


def running_budget(df: DataFrame, ts: str, tokens: Column, budget: float) -> DataFrame:
    """``day, used, pct, level`` by UTC day."""
    from .scoring import budget_level

    d = df.groupBy(F.to_date(ts).alias("day")).agg(F.sum(tokens).alias("used"))
    return d.withColumn("pct", F.round(F.col("used") / F.lit(budget) * 100, 4)).withColumn("level", budget_level(F.col("used"), budget))


def new_in_batch(df: DataFrame, key: str, batch: str) -> DataFrame:
    """Rows of later batches (``batch`` > 0) whose key no earlier batch has; null keys are never new."""
    first = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(batch).alias("__first"))
    return df.join(first, key).where((F.col(batch) > 0) & (F.col(batch) == F.col("__first"))).drop("__first")


def edges_at(edges: DataFrame, source: str, target: str, at_source=None, at_target=None) -> DataFrame:
    """Edges with the given source or the given target."""
    hit = F.lit(False)
    for c, v in ((source, at_source), (target, at_target)):
        if v is not None:
            hit = hit | F.coalesce(F.col(c) == F.lit(v), F.lit(False))
    return edges.where(hit)


def page(df: DataFrame, order: list[str], offset: int, size: int) -> DataFrame:
    """Rows ``offset`` to ``offset + size`` in order, nulls first: paging is the feature."""
    return df.orderBy(*[F.asc_nulls_first(c) for c in order]).offset(offset).limit(size)
