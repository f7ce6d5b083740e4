"""Raw payload store, seeds, result cache and export tabs on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import extension, raw_key


def write_raw(rows: DataFrame, path: str) -> None:
    """Payloads with their manifests, partitioned by source and day. Columns: source_name, fetched_at, content_hash, content_type, payload, headers."""
    d = rows.withColumn("dt", F.to_date("fetched_at")).withColumn("key", raw_key(F.col("source_name"), F.col("content_hash"), F.col("fetched_at"), "payload", extension(F.col("content_type"))))
    d.write.mode("append").partitionBy("source_name", "dt").parquet(path)


def read_raw(spark: SparkSession, path: str, source: str | None = None, day: str | None = None) -> DataFrame:
    d = spark.read.parquet(path)
    if source is not None:
        d = d.where(F.col("source_name") == source)
    return d if day is None else d.where(F.col("dt") == F.lit(day).cast("date"))


def read_seeds(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Seeds from JSON (canonical_id, name, record_type, aliases), in file order; the type defaults to STARTUP, aliases to none.

    The file is one array, or an object a line (``lines``).
    """
    d = spark.read.schema("canonical_id string, name string, record_type string, aliases array<string>").json(path, multiLine=not lines)
    return d.withColumn("record_type", F.coalesce("record_type", F.lit("STARTUP"))).withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>"))).withColumn("pos", F.monotonically_increasing_id())


def uncached(requests: DataFrame, cache: DataFrame, now: str, hours: int = 24) -> DataFrame:
    """Requests (cache_key, ...) without an answer younger than ``hours``."""
    fresh = cache.where(F.col("stored_at") > F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")).select("cache_key")
    return requests.join(fresh, "cache_key", "left_anti")


def cache_answers(answers: DataFrame, path: str, now: str) -> None:
    """Adds answers (cache_key, answer) to the result cache, stored at ``now``."""
    answers.select("cache_key", "answer", F.lit(now).cast("timestamp").alias("stored_at")).write.mode("append").parquet(path)


def append_evidence(rows: DataFrame, path: str) -> None:
    """Adds evidence rows (record_id, field_name, value, evidence, confidence) to the evidence table, which only grows."""
    rows.select(F.col("record_id").cast("long").alias("record_id"), "field_name", "value", "evidence", F.col("confidence").cast("double").alias("confidence")).write.mode("append").parquet(path)


def seed_entities(seeds: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Entities with every seed in it as grounded and confirmed; an entity that is there already becomes a seed."""
    s = seeds.select("canonical_id", F.col("name").alias("entity_name"), "record_type", F.lit("grounded").alias("status"), F.lit(1.0).alias("confidence"), F.lit(True).alias("is_seed"))
    if entities is None:
        return s
    rest = entities.join(s.select("canonical_id"), "canonical_id", "left_anti").select(*s.columns)
    return s.unionByName(rest)


def write_tabs(tabs: dict[str, DataFrame], path: str) -> None:
    """A full refresh of every tab as CSV with a header."""
    for name, df in tabs.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def split_failed(rows: DataFrame, stage_name: str, error: str) -> tuple[DataFrame, DataFrame]:
    """(good rows, dead letters): ``error`` is a column with the reason, null for good rows."""
    dead = rows.where(F.col(error).isNotNull()).select(F.lit(stage_name).alias("stage"), F.col(error).alias("error_type"), F.substring(F.col(error), 1, 1000).alias("error_message"), F.to_json(F.struct(*[c for c in rows.columns if c != error])).alias("original_data"))
    return rows.where(F.col(error).isNull()).drop(error), dead
