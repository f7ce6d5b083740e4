"""Queries of the llm problems over the whole test tables, with SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import load, shared_dir, stage
from .boilerplate import main_content
from .components import folded, group_by_shared_keys, says_something
from .history import HistoryIndex, duplicates_of_history, first_repeated
from .leakage import find_leaks, remove_leaks
from .packing import pack, token_counts
from .pii import find_pii, mask_pii
from .survivor import elect, elect_current


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "review_items").where(F.lower(F.trim("status")) == "resolved").where(F.lower(F.regexp_replace("decision", r"^[\s ]+|[\s ]+$", "")) == "merge")
    cand = F.lower(F.regexp_replace("candidate_canonical_id", r"^[\s ]+|[\s ]+$", ""))
    d = d.select("id", F.when(says_something(cand), cand).alias("by_candidate"), "record_type", folded(F.col("extracted_name")).alias("name"))
    named = F.when(F.col("record_type").isNotNull() & says_something(F.col("name")), F.concat_ws("\u0001", "record_type", F.regexp_replace("name", r"[\s ]+", "")))
    return group_by_shared_keys(d.select("id", "by_candidate", named.alias("by_name")), "id", ["by_candidate", "by_name"]).select("group_id", "id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_content(load(spark, sf_dir, "raw_pages"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elect(load(spark, sf_dir, "source_assertions"), load(spark, sf_dir, "source_registry"))


def p3_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elect_current(load(spark, sf_dir, "source_assertions"), load(spark, sf_dir, "source_registry"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates_of_history(load(spark, sf_dir, "crawl_manifests"), load(spark, sf_dir, "documents"))


def p4_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts only, through the index: each batch adds its shards and meets those of all before; compacted after every third."""
    m = load(spark, sf_dir, "crawl_manifests").select(F.col("manifest_id").alias("id"), F.coalesce("batch_no", F.lit(0)).alias("batch_no"))
    d = stage(load(spark, sf_dir, "documents").select(F.col("manifest_id").alias("id"), "text").join(m, "id"), "batched-texts")
    index, out = HistoryIndex(spark, f"{shared_dir(spark)}/lodestrata/index-{uuid.uuid4().hex}"), None
    for (no,) in d.select("batch_no").distinct().orderBy("batch_no").collect():
        x = index.add(d.where(F.col("batch_no") == no).drop("batch_no"), no)
        x = stage(x, "batch-repeats")
        out = x if out is None else out.unionByName(x)
        if no % 3 == 2:
            index.compact()
    later = d.where("batch_no > 0").select("id").distinct()
    return first_repeated(out).join(later, "id", "left_semi").select(F.col("kept").alias("kept_id"), F.col("id").alias("manifest_id"))


def p8_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(stage(token_counts(load(spark, sf_dir, "documents")), "token-counts"), load(spark, sf_dir, "pack_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))


def p9_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(load(spark, sf_dir, "documents"), load(spark, sf_dir, "papers"))


def p10_masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pii(load(spark, sf_dir, "documents"), load(spark, sf_dir, "papers"))


QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p3_found": p3_found, "p3_current": p3_current, "p4_found": p4_found, "p4_batches": p4_batches, "p8_packed": p8_packed, "p9_found": p9_found, "p9_cleaned": p9_cleaned, "p10_found": p10_found, "p10_masked": p10_masked}

_SK = "regexp_replace(lower(trim({})), '[\\s_-]+', '', 'g')"
ORACLES = {
    "p3_found": f"""
        WITH reg AS (SELECT {_SK.format("source_name")} AS sk, max(credibility) AS cred FROM source_registry GROUP BY 1),
        d AS (SELECT a.entity_id, a.field_name, a.assertion_id, a.fetched_at, reg.cred,
                CASE WHEN grounding_score IS NULL OR isnan(grounding_score) THEN 0 WHEN grounding_score > 1 THEN grounding_score / 100 ELSE grounding_score END AS g,
                value IS NOT NULL AND lower(trim(value)) NOT IN ('', 'n/a', 'unknown', '-', 'none', 'null', 'tbd') AS said,
                count(*) OVER (PARTITION BY a.entity_id, a.field_name) AS n
              FROM source_assertions a LEFT JOIN reg ON reg.sk = {_SK.format("a.source_name")})
        SELECT entity_id, field_name, assertion_id FROM (
          SELECT *, row_number() OVER (PARTITION BY entity_id, field_name ORDER BY g DESC, cred DESC NULLS LAST, fetched_at DESC NULLS LAST, assertion_id) AS r
          FROM d WHERE said AND n > 1) WHERE r = 1""",
    "p9_found": """
        WITH p AS (SELECT item_id, regexp_extract_all(lower(passage), '[\\p{L}\\p{N}]+') AS w FROM eval_items),
        pg AS (SELECT item_id, len(w) AS n, unnest(list_transform(range(1, len(w) - 6), lambda i: {'i': i, 'g': array_to_string(w[i:i + 7], ' ')})) AS x FROM p WHERE len(w) >= 8),
        d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
        dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS g FROM d WHERE len(w) >= 8),
        c AS (SELECT DISTINCT doc_id, item_id, n, unnest(range(x.i, x.i + 8)) AS q FROM pg JOIN dg ON dg.g = pg.x.g)
        SELECT doc_id, item_id FROM c GROUP BY doc_id, item_id, n HAVING 2 * count(*) >= n""",
}
