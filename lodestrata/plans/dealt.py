"""Queries of the general data problems (5, 6, 7) over the whole test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.instants import source_key, to_instants
from ..operators.packed_fields import unpack
from ..operators.redelivery import DeliveryLedger, surplus_deliveries
from ..session import load, shared_dir

PACKED = (("startups", "investors", "list_end"), ("papers", "authors", "always"), ("jobs", "skills", "never"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for tab, column, conjunction in PACKED:
        x = unpack(load(spark, sf_dir, tab), ["record_id"], column, conjunction).select(F.lit(tab).alias("tab"), "record_id", "pos", "item")
        out = x if out is None else out.unionByName(x)
    return out


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surplus_deliveries(load(spark, sf_dir, "queue_messages"))


def p6_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus deliveries as the ledger sees them, ten batches at a time: what an earlier load accepted stays."""
    d = load(spark, sf_dir, "queue_messages").withColumn("load", F.floor(F.col("batch_no") / 10))
    ledger, out = DeliveryLedger(spark, f"{shared_dir(spark)}/lodestrata/ledger-{uuid.uuid4().hex}"), None
    for (no,) in d.select("load").distinct().orderBy("load").collect():
        x = ledger.accept(d.where(F.col("load") == no), no)
        out = x if out is None else out.unionAll(x)
    return out


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # sources whose names collide and that disagree are unknown
    one = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).alias(c)
    reg = load(spark, sf_dir, "source_registry").groupBy(source_key(F.col("source_name")).alias("sk")).agg(one("time_zone"), one("date_order"))
    rows = (
        load(spark, sf_dir, "parsed_dates").select(F.lit("parsed_dates").alias("tab"), F.col("parsed_id").alias("row_id"), F.col("raw").alias("text"), "source_name", "fetched_at")
    ).unionByName(
        load(spark, sf_dir, "crawl_manifests").select(F.lit("crawl_manifests").alias("tab"), F.col("manifest_id").alias("row_id"), F.col("last_modified").alias("text"), "source_name", "fetched_at")
    )
    rows = rows.where("text IS NOT NULL").withColumn("sk", source_key(F.col("source_name"))).join(reg, "sk", "left")
    return to_instants(rows, ["tab", "row_id"], "text", "time_zone", "date_order", "fetched_at")


QUERIES = {"p5_found": p5_found, "p6_found": p6_found, "p6_ledger": p6_ledger, "p7_found": p7_found}

_KEY = "regexp_replace(regexp_replace(regexp_replace(lower(message_id), '[\\s ]', '', 'g'), '^(urn:)?(uuid:)?', ''), '[-{}()_:.]', '', 'g')"
ORACLES = {
    "p6_found": f"""
        SELECT entry_id FROM (SELECT entry_id, row_number() OVER (PARTITION BY uid ORDER BY attempt NULLS LAST, entry_id) AS r
          FROM (SELECT entry_id, attempt, {_KEY} AS uid FROM queue_messages WHERE message_id IS NOT NULL) WHERE uid <> '') WHERE r > 1""",
    "p6_ledger": f"""
        SELECT entry_id FROM (SELECT entry_id, row_number() OVER (PARTITION BY uid ORDER BY batch_no // 10, attempt NULLS LAST, entry_id) AS r
          FROM (SELECT entry_id, batch_no, attempt, {_KEY} AS uid FROM queue_messages WHERE message_id IS NOT NULL) WHERE uid <> '') WHERE r > 1""",
}
