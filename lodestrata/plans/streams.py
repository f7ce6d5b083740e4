"""Streaming queries, drained over the whole tables; where a batch twin exists its SQL checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import flows
from .dealt import _KEY


def stream_dedup(spark, d):
    return flows.drain(flows.dedup_messages(flows.read_stream(spark, f"{d}/queue_messages.parquet"), "3650 days"), "stream-dedup")


def stream_window_counts(spark, d):
    return flows.drain(flows.window_counts(flows.read_stream(spark, f"{d}/events.parquet"), "ts", "event_type"), "stream-windows", "complete")


def stream_dead_letters(spark, d):
    x = flows.dead_letters(flows.read_stream(spark, f"{d}/queue_messages.parquet")).where("error IS NOT NULL").select("entry_id", "error")
    return flows.drain(x, "stream-dead-letters")


def stream_circuit_breaker(spark, d):
    x = flows.read_stream(spark, f"{d}/crawl_manifests.parquet").withColumn("ok", F.coalesce(F.col("status_code") < 400, F.lit(False)))
    return flows.drain(flows.circuit_breaker(x, "source_name", "fetched_at", "ok", 2, 3_600_000_000), "stream-breaker")


def stream_url_dedup(spark, d):
    """Addresses in lower case, once per source and UTC day."""
    x = flows.read_stream(spark, f"{d}/crawl_manifests.parquet").where("source_name IS NOT NULL")
    return flows.drain(flows.dedup_urls(x, F.lower(F.trim("url")), "source_name", "fetched_at", "3650 days"), "stream-urls").select("dup_key", "source_name", F.col("day").cast("string").alias("day"))


def stream_content_dedup(spark, d):
    x = flows.read_stream(spark, f"{d}/crawl_manifests.parquet").where("source_name IS NOT NULL")
    return flows.drain(flows.dedup_contents(x, "content_hash", "source_name"), "stream-contents")


def stream_retries(spark, d):
    """Messages whose worker fails them: those with an attempt left go to the retries, the others to the dead letters."""
    base = flows.own_folder(spark, "stream-retries")
    x = flows.read_stream(spark, f"{d}/queue_messages.parquet").select("entry_id", "attempt", "url")
    fail = lambda df: df.withColumn("error", F.when(F.col("url").isNull() | (F.length("url") % 3 == 0), "unreadable"))
    flows.retry_failed(x, fail, f"{base}/out", f"{base}/checkpoint", 3).awaitTermination()
    part = lambda n: spark.read.parquet(f"{base}/out/{n}").select("entry_id", "attempt", F.lit(n).alias("part"))
    return part("done").unionAll(part("retry")).unionAll(part("dead"))


def stream_export(spark, d):
    """Rows that an export appends, once each."""
    base = flows.own_folder(spark, "stream-export")
    x = flows.read_stream(spark, f"{d}/jobs.parquet").where("verification_status = 'grounded'").select("record_id", "title")
    flows.export_every(x, f"{base}/out", f"{base}/checkpoint", None).awaitTermination()
    return spark.read.schema(x.schema).parquet(f"{base}/out")


def stream_topology(spark, d):
    """Discovery, fetch and extraction as three chained streams: good messages, met with the manifests that answered them, as rows to resolve."""
    m = spark.read.parquet(f"{d}/crawl_manifests.parquet").where("correlation_id IS NOT NULL AND status_code BETWEEN 200 AND 399").select("correlation_id", "manifest_id")
    steps = {
        "discovered": lambda x: flows.dead_letters(x).where("error IS NULL").select("entry_id", "correlation_id", "record_type"),
        "fetched": lambda x: x.join(m, "correlation_id"),
        "extracted": lambda x: x.where("record_type IS NOT NULL").select("entry_id", "manifest_id", F.lower("record_type").alias("kind")),
    }
    return flows.chain(flows.read_stream(spark, f"{d}/queue_messages.parquet"), steps, flows.own_folder(spark, "stream-topology"))["extracted"]


QUERIES = {f.__name__: f for f in (stream_dedup, stream_window_counts, stream_dead_letters, stream_circuit_breaker, stream_url_dedup, stream_content_dedup, stream_retries, stream_export, stream_topology)}
ORACLES = {
    "stream_url_dedup": "SELECT DISTINCT lower(trim(url)) AS dup_key, source_name, cast(cast(fetched_at AT TIME ZONE 'UTC' AS date) AS varchar) AS day FROM crawl_manifests WHERE source_name IS NOT NULL AND url IS NOT NULL AND fetched_at IS NOT NULL",
    "stream_content_dedup": "SELECT DISTINCT content_hash, source_name FROM crawl_manifests WHERE source_name IS NOT NULL AND content_hash IS NOT NULL",
    "stream_retries": """SELECT entry_id, coalesce(attempt, 0) + f AS attempt, CASE WHEN f = 0 THEN 'done' WHEN coalesce(attempt, 0) + f < 3 THEN 'retry' ELSE 'dead' END AS part FROM (SELECT *, CASE WHEN url IS NULL OR length(url) % 3 = 0 THEN 1 ELSE 0 END AS f FROM queue_messages)""",
    "stream_topology": f"""SELECT entry_id, manifest_id, lower(record_type) AS kind FROM queue_messages q JOIN crawl_manifests m ON m.correlation_id = q.correlation_id AND m.status_code BETWEEN 200 AND 399
      WHERE NOT (message_id IS NULL OR {_KEY} = '' OR coalesce(trim(q.url), '') = '' OR coalesce(attempt >= max_attempts, false)) AND record_type IS NOT NULL""",
    "stream_export": "SELECT record_id, title FROM jobs WHERE verification_status = 'grounded'",
    "stream_dedup": f"SELECT DISTINCT uid FROM (SELECT {_KEY} AS uid FROM queue_messages WHERE message_id IS NOT NULL AND received_at IS NOT NULL) WHERE uid <> ''",
    "stream_window_counts": "SELECT epoch_us(date_trunc('hour', ts)) AS start_us, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_dead_letters": f"""SELECT entry_id, error FROM (SELECT entry_id, CASE WHEN message_id IS NULL OR {_KEY} = '' THEN 'missing_identifier' WHEN coalesce(trim(url), '') = '' THEN 'missing_url' WHEN attempt >= max_attempts THEN 'attempts_exhausted' END AS error FROM queue_messages) WHERE error IS NOT NULL""",
}
