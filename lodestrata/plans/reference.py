"""Queries over the reference's operators, on the whole test tables, each with SQL that checks it where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as DT
from ..functions import names as N
from ..functions import pages as P
from ..functions import urls as U
from ..operators import crawling as C
from ..operators import export as X
from ..operators import extraction as E
from ..operators import grounding as G
from ..operators import messages as M
from ..operators import resolve as R
from ..operators import scoring as S
from ..operators import upserts as D
from ..operators import voting as V
from ..session import load, stage

NOW = "2024-11-15 00:00:00"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- SQL that several checks share --------------------------------------------------------------------------------

_UNIT = "CASE WHEN {0} IS NULL OR isnan({0}) THEN 0.0 WHEN {0} > 1 THEN {0} / 100 ELSE {0} END"
_AGE = f"((epoch_us(TIMESTAMPTZ '{NOW}+00') - epoch_us({{0}})) / 86400e6)"
_SCORED = f"""
  sc AS (SELECT *, g * t * r * c AS score FROM (SELECT a.*, {_UNIT.format("a.grounding_score")} AS g, {_UNIT.format("a.trust_score")} AS t, coalesce(reg.credibility, 0.75) AS c,
    CASE WHEN fetched_at IS NULL THEN 0.1 WHEN {_AGE.format("fetched_at")} <= 0 THEN 1.0 ELSE greatest(0.1, pow(2.0, -{_AGE.format("fetched_at")} / 30.0)) END AS r
    FROM source_assertions a LEFT JOIN (SELECT lower(trim(source_name)) AS k, max(credibility) AS credibility FROM source_registry GROUP BY 1) reg ON reg.k = lower(trim(a.source_name))))"""
_VOTED = (
    _SCORED
    + """,
  v0 AS (SELECT *, regexp_replace(trim(lower(value)), '\\s+', ' ', 'g') AS vk, round(score, 9) AS rs FROM sc WHERE value IS NOT NULL),
  v1 AS (SELECT *, row_number() OVER (PARTITION BY entity_id, field_name, vk ORDER BY rs DESC, pos, assertion_id) AS rb FROM v0),
  gr AS (SELECT entity_id, field_name, vk, round(sum(score), 9) AS s, count(*) AS k, min({'p': pos, 'a': assertion_id}) AS fo,
           max(CASE WHEN rb = 1 THEN value END) AS bv, max(CASE WHEN rb = 1 THEN score END) AS bs, max(CASE WHEN rb = 1 THEN g END) AS bg, max(CASE WHEN rb = 1 THEN t END) AS bt FROM v1 GROUP BY ALL),
  g2 AS (SELECT *, row_number() OVER (PARTITION BY entity_id, field_name ORDER BY s DESC, fo) AS rg, sum(s) OVER (PARTITION BY entity_id, field_name) AS total,
           sum(k) OVER (PARTITION BY entity_id, field_name) AS n, count(*) OVER (PARTITION BY entity_id, field_name) AS nv FROM gr),
  votes AS (SELECT entity_id, field_name, bv AS winner, round(CASE WHEN n = 1 THEN least(bg * bt, 0.7) ELSE least(1.0, CASE WHEN total > 0 THEN s / total ELSE 0 END * (0.5 + 0.5 * bs)) END + 1e-9, 4) AS confidence,
           CASE WHEN n = 1 THEN 'single_source' WHEN nv = 1 THEN 'unanimous' WHEN k > n / 2 THEN 'majority_vote' ELSE 'quality_winner' END AS method, nv > 1 AS contested, round(k / n + 1e-9, 3) AS consensus,
           cast(n AS bigint) AS n, nv AS n_values FROM g2 WHERE rg = 1)"""
)


def _scored(spark: SparkSession, d: str) -> DataFrame:
    reg = load(spark, d, "source_registry").groupBy(F.lower(F.trim("source_name")).alias("source_key")).agg(F.max("credibility").alias("credibility"))
    return V.score_assertions(load(spark, d, "source_assertions"), NOW, reg)


# ---- voting, lineage ----------------------------------------------------------------------------------------------


@query(f"WITH {_VOTED} SELECT * FROM votes")
def vote_fields(spark, d):
    return V.vote_fields(_scored(spark, d))


@query(f"WITH {_VOTED} SELECT entity_id, count(*) AS fields, count(*) FILTER (contested) AS contested_fields, count(*) FILTER (NOT contested) AS unanimous_fields, round(avg(confidence) + 1e-9, 4) AS overall_confidence FROM votes GROUP BY 1")
def vote_report(spark, d):
    return V.vote_report(V.vote_fields(_scored(spark, d)))


@query(f"WITH {_SCORED} SELECT assertion_id, round(g + 1e-9, 6) AS g, round(t + 1e-9, 6) AS t, round(r + 1e-9, 6) AS r, round(c + 1e-9, 6) AS c, round(score + 1e-9, 6) AS score FROM sc")
def assertion_score(spark, d):
    return _scored(spark, d).select("assertion_id", *[F.round(F.col(c) + V.TIES, 6).alias(c) for c in ("g", "t", "r", "c", "score")])


@query(f"""WITH {_VOTED}, s AS (SELECT entity_id, count(DISTINCT source_url) AS sources FROM sc GROUP BY 1),
  f AS (SELECT entity_id, count(*) AS fields, coalesce(array_to_string(list_sort(list(DISTINCT field_name) FILTER (contested)), ','), '') AS contested_fields, round(avg(confidence) + 1e-9, 4) AS mean_confidence FROM votes GROUP BY 1)
  SELECT entity_id, fields, contested_fields, mean_confidence, sources FROM f JOIN s USING (entity_id)""")
def lineage_entity(spark, d):
    x = _scored(spark, d)
    return G.lineage(V.vote_fields(x), x)


@query(f"""WITH {_VOTED} SELECT sc.assertion_id, entity_id, field_name, CASE WHEN v.n = 1 THEN 'single_source' WHEN regexp_replace(trim(lower(sc.value)), '\\s+', ' ', 'g') = regexp_replace(trim(lower(v.winner)), '\\s+', ' ', 'g') THEN 'winner' ELSE 'dissenter' END AS role,
  round(sc.g * sc.t + 1e-9, 4) AS quality, sc.g >= 0.6 AS passed FROM sc JOIN votes v USING (entity_id, field_name) WHERE sc.value IS NOT NULL""")
def lineage_traces(spark, d):
    x = _scored(spark, d)
    return G.lineage_traces(V.vote_fields(x), x)


# ---- scores -------------------------------------------------------------------------------------------------------

_FRESH = f"""fr AS (SELECT *, age / max_days AS rr FROM (SELECT doc_id, record_type, {_AGE.format("fetched_at")} AS age,
  CASE record_type WHEN 'STARTUP' THEN 14.0 WHEN 'PRODUCT' THEN 30.0 WHEN 'NEWS' THEN 1.0 WHEN 'NEWS_SIGNAL' THEN 1.0 WHEN 'JOB' THEN 7.0 WHEN 'PAPER' THEN 90.0 ELSE 30.0 END AS max_days FROM documents)),
  f2 AS (SELECT doc_id, max_days, CASE WHEN age IS NULL THEN 0.0 WHEN age <= 0 THEN 100.0 ELSE 100 * pow(2.0, -rr) END AS fresh_score, CASE WHEN age IS NULL THEN 1.0 ELSE greatest(0.0, least(1.0, rr)) END AS priority,
  CASE WHEN rr IS NULL OR rr >= 2 THEN 'critical' WHEN rr >= 1 THEN 'stale' WHEN rr >= 0.7 THEN 'aging' ELSE 'fresh' END AS level FROM fr)"""


def _fresh(spark, d):
    return S.assess_freshness(load(spark, d, "documents").select("doc_id", "record_type", "fetched_at"), NOW)


@query(f"WITH {_FRESH} SELECT doc_id, max_days, round(fresh_score, 6) AS fresh_score, round(priority, 6) AS priority, level FROM f2")
def freshness_levels(spark, d):
    return _fresh(spark, d).select("doc_id", "max_days", F.round("fresh_score", 6).alias("fresh_score"), F.round("priority", 6).alias("priority"), "level")


@query(f"WITH {_FRESH} SELECT doc_id, level, round(priority, 6) AS priority FROM f2 WHERE level <> 'fresh' ORDER BY f2.priority DESC, doc_id LIMIT 20")
def recrawl_topk(spark, d):
    return S.recrawl_queue(_fresh(spark, d), "doc_id").select("doc_id", "level", F.round("priority", 6).alias("priority"))


_QUALITY = f"""{_VOTED}, q0 AS (SELECT entity_id, count(DISTINCT source_url) AS ns, avg(g) AS mg, avg(t) AS mt, count(DISTINCT field_name) AS nf, min({_AGE.format("fetched_at")}) AS age FROM sc GROUP BY 1),
  q1 AS (SELECT entity_id, avg(consensus) AS mc FROM votes GROUP BY 1),
  q2 AS (SELECT entity_id, CASE WHEN ns <= 0 THEN 0.0 WHEN ns = 1 THEN 40.0 WHEN ns = 2 THEN 70.0 ELSE least(100.0, 85 + 15 * log2(ns - 2)) END AS source_diversity, mg * 100 AS grounding, coalesce(mc, 0) * 100 AS consensus, mt * 100 AS trust,
    least(100.0, nf / 8 * 100) AS completeness, CASE WHEN age IS NULL THEN 0.0 WHEN age <= 0 THEN 100.0 ELSE greatest(10.0, 100 * pow(2.0, -age / 30)) END AS freshness FROM q0 LEFT JOIN q1 USING (entity_id)),
  q3 AS (SELECT *, round(source_diversity * 0.15 + grounding * 0.25 + consensus * 0.25 + trust * 0.15 + completeness * 0.10 + freshness * 0.10 + 1e-9, 4) AS score FROM q2)"""


def _quality(spark, d):
    x = _scored(spark, d)
    a = x.groupBy("entity_id").agg(F.count_distinct("source_url").alias("ns"), F.avg("g").alias("mg"), F.avg("t").alias("mt"), F.count_distinct("field_name").alias("nf"), F.min(S.age_days(F.col("fetched_at"), NOW)).alias("age"))
    c = V.vote_fields(x).groupBy("entity_id").agg(F.avg("consensus").alias("mc"))
    q = a.join(c, "entity_id", "left").select(
        "entity_id", S.source_diversity(F.col("ns")).alias("source_diversity"), S.percent(F.col("mg")).alias("grounding"), S.percent(F.coalesce("mc", F.lit(0.0))).alias("consensus"), S.percent(F.col("mt")).alias("trust"),
        S.completeness(F.col("nf"), F.lit(8)).alias("completeness"), S.freshness(F.col("age")).alias("freshness"),
    )
    return S.quality(q)


@query(f"""WITH {_QUALITY} SELECT entity_id, score, score >= 60 AS exportable, score >= 60 AND score < 75 AS needs_review, source_diversity < 40 OR freshness < 40 OR grounding < 40 AS needs_recrawl FROM q3""")
def quality_scores(spark, d):
    return _quality(spark, d).select("entity_id", "score", "exportable", "needs_review", "needs_recrawl")


@query(f"""WITH {_QUALITY} SELECT CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' WHEN score >= 40 THEN 'D' ELSE 'F' END AS grade, count(*) AS entities, round(avg(score) + 1e-9, 3) AS mean_score FROM q3 GROUP BY 1""")
def quality_distribution(spark, d):
    return _quality(spark, d).groupBy("grade").agg(F.count(F.lit(1)).alias("entities"), F.round(F.avg("score") + V.TIES, 3).alias("mean_score"))


@query(f"""WITH {_SCORED} SELECT entity_id, round(greatest(0.0, least(1.0, 0.3 * least(res, 1.0) + 0.3 * least(gr, 1.0) + 0.2 * least(ns / 5, 1.0) + 0.1 * ok + 0.1 * CASE WHEN age <= 7 THEN 1.0 WHEN age <= 30 THEN 0.8 WHEN age <= 90 THEN 0.5 ELSE 0.2 END)) + 1e-9, 4) AS confidence
  FROM (SELECT entity_id, coalesce(avg(llm_confidence) FILTER (NOT isnan(llm_confidence)), 0) AS res, avg(g) AS gr, count(DISTINCT source_url) AS ns, CASE WHEN count(DISTINCT field_name) >= 3 THEN 1.0 ELSE 0.0 END AS ok, floor(min({_AGE.format("fetched_at")})) AS age FROM sc GROUP BY 1)""")
def entity_confidence(spark, d):
    a = _scored(spark, d).groupBy("entity_id").agg(
        F.coalesce(F.avg(F.when(~F.isnan("llm_confidence"), F.col("llm_confidence"))), F.lit(0.0)).alias("res"), F.avg("g").alias("gr"), F.count_distinct("source_url").alias("ns"),
        (F.count_distinct("field_name") >= 3).alias("ok"), F.floor(F.min(S.age_days(F.col("fetched_at"), NOW))).alias("age"),
    )
    return a.select("entity_id", S.entity_confidence(F.col("res"), F.col("gr"), F.col("ns"), F.col("ok"), F.col("age"), F.lit(False)).alias("confidence"))


@query("""SELECT id, round(0.4 * least(similarity_score, 1.0) + 0.4 * similarity_score + 0.2 * CASE WHEN status = 'resolved' THEN 1.0 ELSE 0.5 END + 1e-9, 4) AS confidence FROM review_items WHERE similarity_score IS NOT NULL AND NOT isnan(similarity_score)""")
def edge_confidence(spark, d):
    x = load(spark, d, "review_items").where("similarity_score IS NOT NULL AND NOT isnan(similarity_score)")
    return x.select("id", S.edge_confidence(F.col("similarity_score"), F.lit(1.0), F.col("similarity_score"), F.col("status") == "resolved").alias("confidence"))


# ---- addresses, names, keys ---------------------------------------------------------------------------------------

_NORM = """regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1) AS sch, regexp_replace(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)), '^www\\.', '') AS host,
  regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) AS qs"""
_SHORT = "'utm_source','utm_medium','utm_campaign','utm_term','utm_content','fbclid','gclid','ref','source'"
_KEEP = "CASE WHEN qs = '' THEN '' ELSE array_to_string({0}list_filter(string_split(qs, '&'), lambda x: lower(string_split(x, '=')[1]) NOT IN ({1})){2}, '&') END"


@query(f"""SELECT manifest_id, CASE WHEN sch = '' THEN 'https' ELSE lower(sch) END || '://' || host || CASE WHEN path = '/' THEN path ELSE rtrim(path, '/') END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS normalized
  FROM (SELECT *, {_KEEP.format("list_sort(", _SHORT + ",'mc_cid','mc_eid','s_cid','trk'", ")")} AS q FROM (SELECT manifest_id, {_NORM} FROM crawl_manifests WHERE url IS NOT NULL))""")
def url_normalize(spark, d):
    return load(spark, d, "crawl_manifests").where("url IS NOT NULL").select("manifest_id", U.normalize_url(F.col("url")).alias("normalized"))


@query(f"""SELECT manifest_id, 'https://' || host || rtrim(path, '/') || CASE WHEN q = '' THEN '' ELSE '?' || q END AS sanitized
  FROM (SELECT *, {_KEEP.format("", _SHORT, "")} AS q FROM (SELECT manifest_id, {_NORM} FROM crawl_manifests WHERE url IS NOT NULL))""")
def url_sanitize(spark, d):
    return load(spark, d, "crawl_manifests").where("url IS NOT NULL").select("manifest_id", U.sanitize_url(F.col("url")).alias("sanitized"))


@query(f"SELECT host AS domain, count(*) AS pages FROM (SELECT {_NORM} FROM crawl_manifests WHERE url IS NOT NULL) GROUP BY 1")
def domain_counts(spark, d):
    return load(spark, d, "crawl_manifests").where("url IS NOT NULL").groupBy(U.extract_domain(F.col("url")).alias("domain")).agg(F.count(F.lit(1)).alias("pages"))


@query("""SELECT c_custkey, list_filter(string_split('/' || replace(c_name, '#', '-') || '/' || c_mktsegment, '/'), lambda x: x <> '')[1] || '/' || list_filter(string_split('/' || replace(c_name, '#', '-') || '/' || c_mktsegment, '/'), lambda x: x <> '')[2] AS repo FROM customer""")
def owner_repo(spark, d):
    return load(spark, d, "customer").select("c_custkey", U.owner_repo(F.concat(F.lit("https://host.example/"), F.regexp_replace("c_name", "#", "-"), F.lit("/"), "c_mktsegment")).alias("repo"))


_LEGAL_SQL = "lower(trim(extracted_name))"
for _p in ("inc\\.?", "ltd\\.?", "corp\\.?", "llc\\.?", "plc\\.?", "gmbh", "co\\.", "limited", "corporation", "company"):
    _LEGAL_SQL = f"regexp_replace({_LEGAL_SQL}, '\\b{_p}(\\s|$)', '\\1', 'g')"


@query()
def name_sanitize(spark, d):
    return load(spark, d, "review_items").where("extracted_name IS NOT NULL").select("id", N.sanitize_entity_name(F.col("extracted_name")).alias("clean"))


_NORM_NAME = "trim(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(lower({0})), '\\s*\\(.*?\\)\\s*', ' ', 'g'), '" + N.BROAD + "', '', 'g'), '[-–—_]+', ' ', 'g'), '\\s+', ' ', 'g')), '.,;:!?-—–''\"')"


@query(f"SELECT record_id, {_NORM_NAME.format('entity_name')} AS normalized, 'startup_' || CASE WHEN {_NORM_NAME.format('entity_name')} = '' THEN 'unknown' ELSE trim(regexp_replace(regexp_replace(regexp_replace({_NORM_NAME.format('entity_name')}, '\\s+', '-', 'g'), '[^a-z0-9-]', '', 'g'), '-+', '-', 'g'), '-') END AS canonical FROM startups WHERE entity_name IS NOT NULL AND regexp_full_match(entity_name, '[\\x00-\\x7F]*')")
def name_normalize(spark, d):
    x = load(spark, d, "startups").where("entity_name IS NOT NULL")
    return x.select("record_id", N.normalize_entity_name(F.col("entity_name")).alias("normalized"), N.canonical_id(F.col("entity_name"), F.lit("STARTUP")).alias("canonical"))


@query("""SELECT manifest_id, sha256(lower(coalesce(content_hash, ''))) AS content_key, substr(sha256(concat_ws(':', coalesce(content_hash, ''), '1.0', '4', 'm1', 'PAPER')), 1, 32) AS cache_key,
  CASE WHEN raw_s3_key IS NULL THEN NULL WHEN len(string_split(raw_s3_key, '/')) >= 6 THEN string_split(raw_s3_key, '/')[-2] ELSE '' END AS key_hash,
  'raw/' || source_name || '/' || strftime(fetched_at AT TIME ZONE 'UTC', '%Y/%m/%d') || '/' || content_hash || '/metadata.json' AS metadata_key FROM crawl_manifests""")
def raw_keys(spark, d):
    x = load(spark, d, "crawl_manifests")
    h = F.coalesce("content_hash", F.lit(""))
    return x.select("manifest_id", N.content_hash(F.lower(h)).alias("content_key"), N.cache_key(h, F.lit("m1"), F.lit("PAPER")).alias("cache_key"), F.when(F.col("raw_s3_key").isNotNull(), N.hash_of_key(F.col("raw_s3_key"))).alias("key_hash"), N.raw_key(F.col("source_name"), F.col("content_hash"), F.col("fetched_at"), "metadata").alias("metadata_key"))


@query("SELECT doc_id, cast(greatest(1, length(text) // 4) AS int) AS tokens FROM documents WHERE text IS NOT NULL")
def token_estimate(spark, d):
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", N.estimate_tokens(F.col("text")).alias("tokens"))


# ---- deduplication and upserts ------------------------------------------------------------------------------------


@query("SELECT source_name, content_hash, min(manifest_id) AS manifest_id FROM crawl_manifests WHERE content_hash IS NOT NULL GROUP BY 1, 2")
def content_dedup(spark, d):
    x = load(spark, d, "crawl_manifests").where("content_hash IS NOT NULL").select("source_name", "content_hash", "manifest_id")
    return D.first_rows(x, ["source_name", "content_hash"], ["manifest_id"])


@query()
def url_day_dedup(spark, d):
    x = load(spark, d, "crawl_manifests").where("url IS NOT NULL AND fetched_at IS NOT NULL AND source_name IS NOT NULL")
    return D.url_day_dedup(x, N.dedup_hash(F.col("url"), F.lit(""), F.col("source_name")), "fetched_at", "manifest_id").select("manifest_id", F.col("day").cast("string").alias("day"), "is_duplicate")


@query("""SELECT entity_id, arg_min(value, {'p': pos, 'a': assertion_id}) AS name, arg_max(source_name, {'p': pos, 'a': assertion_id}) AS source_name, arg_max(source_url, {'p': pos, 'a': assertion_id}) AS source_url, count(*) AS source_count
  FROM source_assertions WHERE value IS NOT NULL AND source_name IS NOT NULL AND source_url IS NOT NULL GROUP BY 1""")
def entity_upsert(spark, d):
    x = load(spark, d, "source_assertions").where("value IS NOT NULL AND source_name IS NOT NULL AND source_url IS NOT NULL").withColumnRenamed("value", "name")
    return D.upsert_fold(x, "entity_id", ["pos", "assertion_id"], ["name"], ["source_name", "source_url"])


@query("""SELECT canonical_id AS source, company AS target, source_url, max(record_id) AS record_id FROM jobs WHERE trim(company) <> '' AND source_url IS NOT NULL GROUP BY 1, 2, 3""")
def edge_dedup(spark, d):
    x = load(spark, d, "jobs").where("trim(company) <> '' AND source_url IS NOT NULL").select(F.col("canonical_id").alias("source"), F.col("company").alias("target"), "source_url", "record_id")
    return D.last_rows(x, ["source", "target", "source_url"], ["record_id"])


@query("""SELECT url, source_name, status_code, fetch_tier FROM (SELECT url, source_name, status_code, fetch_tier, row_number() OVER (PARTITION BY url, source_name ORDER BY fetched_at DESC NULLS LAST, manifest_id DESC) AS r FROM crawl_manifests) WHERE r = 1""")
def latest_state(spark, d):
    x = load(spark, d, "crawl_manifests").select("url", "source_name", "status_code", "fetch_tier", "fetched_at", "manifest_id")
    return D.last_rows(x, ["url", "source_name"], ["fetched_at", "manifest_id"]).select("url", "source_name", "status_code", "fetch_tier")


@query("""SELECT record_id, canonical_id, CASE WHEN verification_status IN ('grounded', 'partial') THEN epoch_us(updated_at) END AS exported_us FROM startups""")
def exported_marks(spark, d):
    x = load(spark, d, "startups").select("record_id", "canonical_id", F.lit(None).cast("timestamp").alias("exported_at"), "verification_status", "updated_at")
    done = x.where("verification_status IN ('grounded', 'partial')").select("record_id", F.col("updated_at").alias("exported_at"))
    return D.mark_exported(x.select("record_id", "canonical_id", "exported_at"), done, "record_id").select("record_id", "canonical_id", F.unix_micros("exported_at").alias("exported_us"))


@query("SELECT manifest_id FROM (SELECT manifest_id, batch_no, min(batch_no) OVER (PARTITION BY content_hash) AS f FROM crawl_manifests WHERE content_hash IS NOT NULL) WHERE batch_no > 0 AND batch_no = f")
def content_unseen(spark, d):
    return D.new_in_batch(load(spark, d, "crawl_manifests"), "content_hash", "batch_no").select("manifest_id")


@query("""SELECT cast(cast(timestamp_at AT TIME ZONE 'UTC' AS date) AS varchar) AS day, sum(cast(length(url) // 4 AS bigint))::bigint AS used, round(sum(length(url) // 4) / 20000.0 * 100, 3) AS pct,
  CASE WHEN sum(length(url) // 4) / 20000.0 * 100 >= 100 THEN 'halt' WHEN sum(length(url) // 4) / 20000.0 * 100 >= 90 THEN 'saving' WHEN sum(length(url) // 4) / 20000.0 * 100 >= 80 THEN 'warn' ELSE 'ok' END AS level
  FROM queue_messages WHERE url IS NOT NULL GROUP BY 1""")
def budget_daily(spark, d):
    x = load(spark, d, "queue_messages").where("url IS NOT NULL")
    return D.running_budget(x, "timestamp_at", F.floor(F.length("url") / 4), 20000.0).withColumn("pct", F.round("pct", 3)).withColumn("day", F.col("day").cast("string"))


@query("""SELECT event_id, cast(n AS bigint) AS in_window, n <= 12 AS admitted FROM (SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) AS n FROM events)""")
def rate_window(spark, d):
    return M.sliding_window(load(spark, d, "events"), "user_id", "ts").select("event_id", "in_window", "admitted")


@query("""SELECT source_name, fetch_tier, count(*) AS fetches, count(*) FILTER (status_code >= 200 AND status_code < 400) AS ok, count(*) FILTER (status_code = 429) AS rate_limited, count(*) FILTER (status_code BETWEEN 500 AND 599) AS server_errors,
  round(count(*) FILTER (status_code >= 200 AND status_code < 400) / count(*), 4) AS success_rate FROM crawl_manifests GROUP BY 1, 2""")
def fetch_stats(spark, d):
    c = F.col("status_code")
    g = load(spark, d, "crawl_manifests").groupBy("source_name", "fetch_tier")
    x = g.agg(F.count(F.lit(1)).alias("fetches"), F.count_if((c >= 200) & (c < 400)).alias("ok"), F.count_if(c == 429).alias("rate_limited"), F.count_if(c.between(500, 599)).alias("server_errors"))
    return x.withColumn("success_rate", F.round(F.col("ok") / F.col("fetches"), 4))


# ---- grounding ----------------------------------------------------------------------------------------------------

#: Fields read from documents by rule: name, pattern of the evidence, pattern of the value in it.
_RULES = (
    ("fundingTotal", r"\b(?:closed|Finanzierungsrunde|ronda)\b[^.\n]*", r"([$€£]?\d[\d,.]*\d? ?(?:million|billion|M|B|m)\b)"),
    ("foundedDate", r"The company was founded in \d{4}[^.\n]*", r"(\d{4})"),
    ("employeeCount", r"employs \d[\d,]* people[^.\n]*", r"(\d[\d,]*)"),
    ("website", r"@[\w.-]+\.(?:test|example|invalid)", r"@([\w.-]+)"),
)


def _sq(p: str) -> str:
    return p.replace("'", "''")


_FIELDS_SQL = "fl AS (" + " UNION ALL ".join(
    f"SELECT doc_id AS record_id, record_type, '{n}' AS field_name, regexp_extract(regexp_extract(text, '{_sq(e)}', 0), '{_sq(v)}', 1) AS value, CASE WHEN doc_id % 7 = 0 THEN 'It is known that ' || regexp_extract(text, '{_sq(e)}', 0) WHEN doc_id % 11 = 0 THEN 'page says so' ELSE regexp_extract(text, '{_sq(e)}', 0) END AS evidence, (doc_id % 100) / 100.0 AS confidence, text AS source FROM documents WHERE text IS NOT NULL AND regexp_extract(text, '{_sq(e)}', 0) <> ''"
    for n, e, v in _RULES
) + ")"


def _fields(spark, d):
    """The long field table: every document's rule-based fields, with some evidence spoilt so that checks have work."""
    x = load(spark, d, "documents").where("text IS NOT NULL")
    out = []
    for n, e, v in _RULES:
        ev = F.regexp_extract("text", e, 0)
        spoilt = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("It is known that "), ev)).when(F.col("doc_id") % 11 == 0, F.lit("page says so")).otherwise(ev)
        out.append(x.select(F.col("doc_id").alias("record_id"), "record_type", F.lit(n).alias("field_name"), ev.alias("ev"), F.regexp_extract(ev, v, 1).alias("value"), spoilt.alias("evidence"), (F.col("doc_id") % 100 / 100.0).alias("confidence"), F.col("text").alias("source")).where("ev <> ''").drop("ev"))
    r = out[0]
    for o in out[1:]:
        r = r.unionAll(o)
    return r


_FLAT = "trim(regexp_replace(lower({0}), '\\s+', ' ', 'g'))"
_NUMS = "list_filter(list_transform(regexp_extract_all(@, '" + G.NUMBER.replace("'", "''") + "', 0), lambda z: try_cast(replace(regexp_extract(z, '(\\d[\\d,]*\\.?\\d*)', 1), ',', '') AS double) * CASE lower(regexp_extract(z, '" + G.NUMBER + "', 2)) WHEN 'k' THEN 1e3 WHEN 'thousand' THEN 1e3 WHEN 'm' THEN 1e6 WHEN 'mm' THEN 1e6 WHEN 'million' THEN 1e6 WHEN 'b' THEN 1e9 WHEN 'bn' THEN 1e9 WHEN 'billion' THEN 1e9 WHEN 't' THEN 1e12 WHEN 'trillion' THEN 1e12 ELSE 1.0 END), lambda z: z IS NOT NULL)"


@query(f"WITH {_FIELDS_SQL} SELECT record_id, field_name, value, contains({_FLAT.format('source')}, {_FLAT.format('evidence')}) AS evidence_in_source, contains(lower(evidence), lower(value)) AS value_in_evidence FROM fl")
def evidence_grounding_exact(spark, d):
    return G.contained(_fields(spark, d)).select("record_id", "field_name", "value", "evidence_in_source", "value_in_evidence")


@query(f"WITH {_FIELDS_SQL} SELECT record_id, field_name, round(len(list_filter(string_split(ef, ' '), lambda w: list_contains(sf, w))) / len(string_split(ef, ' ')), 6) AS overlap FROM (SELECT record_id, field_name, {_FLAT.format('evidence')} AS ef, string_split({_FLAT.format('source')}, ' ') AS sf FROM fl)")
def evidence_word_overlap(spark, d):
    return _fields(spark, d).select("record_id", "field_name", F.round(G.word_overlap(F.col("evidence"), F.col("source")), 6).alias("overlap"))


@query("SELECT assertion_key AS record_id, evidence_key, fields FROM (SELECT entity_id AS assertion_key, lower(trim(evidence_text)) AS evidence_key, count(*) AS fields FROM source_assertions WHERE length(lower(trim(evidence_text))) >= 10 GROUP BY 1, 2) WHERE fields >= 3")
def duplicate_evidence(spark, d):
    return G.duplicate_evidence(load(spark, d, "source_assertions").select(F.col("entity_id").alias("record_id"), F.col("evidence_text").alias("evidence")))


@query("SELECT entity_id AS record_id, count(*) AS fields FROM source_assertions WHERE llm_confidence IS NOT NULL GROUP BY 1 HAVING count(*) >= 2 AND count(DISTINCT round(llm_confidence, 3)) = 1")
def uniform_confidence(spark, d):
    return G.uniform_confidence(load(spark, d, "source_assertions").select(F.col("entity_id").alias("record_id"), F.col("llm_confidence").alias("confidence")), 2)


@query(f"""WITH {_FIELDS_SQL}, a AS (SELECT DISTINCT record_id FROM fl), h AS (SELECT record_id, count(DISTINCT field_name) FILTER (trim(value) <> '' AND field_name IN ('fundingTotal', 'foundedDate', 'employeeCount')) AS n FROM fl GROUP BY 1)
  SELECT record_id, cast(3 - n AS int) AS missing, CASE WHEN 3 - n > 1 THEN 'critical' ELSE 'warning' END AS severity FROM a JOIN h USING (record_id) WHERE n < 3""")
def missing_required(spark, d):
    return G.missing_required(_fields(spark, d), ["fundingTotal", "foundedDate", "employeeCount"])


@query(f"SELECT doc_id, cast(len(n) AS int) AS numbers, round(coalesce(list_max(n), 0), 2) AS largest FROM (SELECT doc_id, {_NUMS.replace('@', 'text')} AS n FROM documents WHERE text IS NOT NULL)")
def numeric_extract(spark, d):
    n = G.all_numbers(F.col("text"))
    return load(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.size(n).alias("numbers"), F.round(F.coalesce(F.array_max(n), F.lit(0.0)), 2).alias("largest"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice <> 0 AND abs(round(l_extendedprice) - l_extendedprice) <= abs(l_extendedprice) * 0.000005 AS close FROM lineitem")
def numeric_tolerance(spark, d):
    return load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", G.near_number(F.round("l_extendedprice"), F.array("l_extendedprice"), 0.000005).alias("close"))


@query("""SELECT o_orderkey, count(*) AS lines, count(*) FILTER (abs(epoch_us(l_shipdate) - epoch_us(o_orderdate)) <= 86400000000) AS within_a_day, round(max(CASE WHEN abs(epoch_us(l_shipdate) - epoch_us(o_orderdate)) <= 86400000000 THEN 1 - abs(epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000 ELSE 0 END), 6) AS best
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def date_tolerance(spark, d):
    diff = F.abs(F.unix_micros(F.col("l_shipdate").cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp")))
    x = load(spark, d, "orders").select("o_orderkey", "o_orderdate").join(load(spark, d, "lineitem").select("l_orderkey", "l_shipdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    near = diff <= 86_400_000_000
    return x.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.count_if(near).alias("within_a_day"), F.round(F.max(F.when(near, 1 - diff / 86_400_000_000).otherwise(0.0)), 6).alias("best"))


def _flags(spark, d):
    v = G.verify_field(_fields(spark, d))
    return v, G.field_flags(v, 2024)


#: The fields that these rules must find in every record.
_REQUIRED = ["fundingTotal", "foundedDate", "employeeCount"]


def _all_flags(spark, d):
    """The fields and the flags of all checks, of fields and of whole records."""
    x = G.field_checks(G.verify_field(_fields(spark, d)), 2024)
    # every check reads the fields, so they are verified once and kept without their texts
    x = stage(x.select("record_id", "field_name", "value", "evidence", "confidence", "status", "flags"), "checked-fields")
    return x, G.flag_rows(x).unionByName(G.record_flags(x, _REQUIRED))


@query()
def field_status(spark, d):
    return G.verify_field(_fields(spark, d)).select("record_id", "field_name", G.classify_field(F.col("field_name")).alias("field_class"), "status", "grounding")


@query()
def field_flags(spark, d):
    return _flags(spark, d)[1]


@query()
def trust_score(spark, d):
    return G.trust(*_all_flags(spark, d))


@query()
def record_status(spark, d):
    return G.record_status(*_all_flags(spark, d))


@query()
def partial_ratio_grounding(spark, d):
    from ..functions.similarity import partial_ratio_udf

    x = load(spark, d, "source_assertions").where("value IS NOT NULL AND evidence_text IS NOT NULL")
    return x.select("assertion_id", F.round(partial_ratio_udf(F.lower(F.trim("value")), F.lower("evidence_text")), 4).alias("ratio"))


# ---- resolution ---------------------------------------------------------------------------------------------------


def _seeds(spark, d):
    """Candidate entities of reviews are the seeds; an alias is the name in front of its last word."""
    x = load(spark, d, "review_items").where("trim(candidate_name) <> '' AND trim(candidate_canonical_id) <> ''")
    s = x.groupBy(F.lower(F.trim("candidate_canonical_id")).alias("canonical_id")).agg(F.min("candidate_name").alias("name"), F.min("record_type").alias("record_type"), F.min("id").alias("pos"))
    return s.withColumn("aliases", F.array(F.concat("name", F.lit(" Labs"))))


def _queries(spark, d):
    return load(spark, d, "review_items").select(F.col("id").alias("qid"), F.col("extracted_name").alias("qname"), "record_type")


_SEEDS_SQL = """sd AS (SELECT lower(trim(candidate_canonical_id)) AS canonical_id, min(candidate_name) AS name, min(record_type) AS record_type, min(id) AS pos FROM review_items WHERE trim(candidate_name) <> '' AND trim(candidate_canonical_id) <> '' GROUP BY 1),
  nm AS (SELECT canonical_id, pos, name FROM sd UNION ALL SELECT canonical_id, pos, name || ' Labs' FROM sd),
  lk AS (SELECT lower(name) AS k, arg_max(canonical_id, {'p': pos, 'c': canonical_id}) AS matched FROM nm GROUP BY 1)"""


@query(f"WITH {_SEEDS_SQL} SELECT id AS qid, matched AS canonical_id FROM review_items JOIN lk ON lower(extracted_name) = k")
def seed_exact(spark, d):
    names = R.seed_names(_seeds(spark, d)).withColumn("k", F.lower("name")).groupBy("k").agg(F.max_by("canonical_id", F.struct("pos", "canonical_id")).alias("canonical_id"))
    return _queries(spark, d).withColumn("k", F.lower("qname")).join(names, "k").select("qid", "canonical_id")


@query()
def cascade_resolve(spark, d):
    return R.resolve_cascade(_queries(spark, d), _seeds(spark, d), embed=R.name_vectors).withColumn("confidence", F.round("confidence", 6))


@query()
def fuzzy_topk(spark, d):
    return R.fuzzy_topk(_queries(spark, d), R.seed_names(_seeds(spark, d)).select("canonical_id", "name", "record_type"))


@query("""WITH p AS (SELECT record_id, unnest(list_distinct(list_concat(['p:' || substr(n, 1, 3)], list_transform(list_filter(regexp_split_to_array(n, '\\s+'), lambda w: length(w) >= 2), lambda w: 't:' || w)))) AS bk FROM (SELECT record_id, lower(trim(entity_name)) AS n FROM papers WHERE trim(entity_name) <> '')),
  q AS (SELECT record_id, unnest(list_distinct(list_concat(['p:' || substr(n, 1, 3)], list_transform(list_filter(regexp_split_to_array(n, '\\s+'), lambda w: length(w) >= 2), lambda w: 't:' || w)))) AS bk FROM (SELECT record_id, lower(trim(entity_name)) AS n FROM startups WHERE trim(entity_name) <> ''))
  SELECT q.record_id AS qid, count(DISTINCT p.record_id) AS candidates FROM q JOIN p ON p.bk = q.bk WHERE length(q.bk) > 3 GROUP BY 1""")
def block_candidates(spark, d):
    q = load(spark, d, "startups").where("trim(entity_name) <> ''").select(F.col("record_id").alias("qid"), F.col("entity_name").alias("qname"))
    n = load(spark, d, "papers").where("trim(entity_name) <> ''").select(F.col("record_id").cast("string").alias("canonical_id"), F.col("entity_name").alias("name"))
    return R.block_candidates(q, n, None).groupBy("qid").agg(F.count_distinct("canonical_id").alias("candidates"))


@query("""WITH s AS (SELECT vec_id AS seed_id, embedding::DOUBLE[] AS sv FROM embeddings WHERE vec_id < 50), p AS (SELECT vec_id AS pid, embedding::DOUBLE[] AS pv FROM embeddings WHERE vec_id >= 50),
  c AS (SELECT pid, seed_id, round(list_cosine_similarity(pv, sv), 6) AS score FROM p, s) SELECT pid, arg_min(seed_id, {'s': -score, 'i': seed_id}) AS seed_id, max(score) AS score, CASE WHEN max(score) >= 0.88 THEN 'accept' WHEN max(score) >= 0.75 THEN 'review' ELSE 'none' END AS band FROM c GROUP BY 1""")
def embedding_match(spark, d):
    e = load(spark, d, "embeddings")
    return R.vector_match(e.where("vec_id >= 50").select(F.col("vec_id").alias("pid"), F.col("embedding").alias("vec")), e.where("vec_id < 50").select(F.col("vec_id").alias("seed_id"), F.col("embedding").alias("vec")))


@query("""WITH c AS (SELECT p.vec_id AS pid, s.vec_id AS seed_id, round(list_cosine_similarity(p.embedding::DOUBLE[], s.embedding::DOUBLE[]), 6) AS score FROM embeddings p, embeddings s WHERE p.vec_id % 100 = 0 AND s.vec_id <> p.vec_id)
  SELECT pid, arg_min(seed_id, {'s': -score, 'i': seed_id}) AS seed_id, max(score) AS score, CASE WHEN max(score) >= 0.88 THEN 'accept' WHEN max(score) >= 0.75 THEN 'review' ELSE 'none' END AS band FROM c GROUP BY 1""")
def embedding_nearest(spark, d):
    e = load(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return R.nearest_vectors(e.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "pid"), e.withColumnRenamed("vec_id", "seed_id"))


@query("SELECT id, extracted_name, record_type FROM review_items WHERE status = 'needs_review'")
def review_pending(spark, d):
    return R.pending_reviews(load(spark, d, "review_items")).select("id", "extracted_name", "record_type")


@query("SELECT record_type, count(*) AS total, count(*) FILTER (status IN ('pending', 'needs_review')) AS pending, count(*) FILTER (status NOT IN ('pending', 'needs_review')) AS resolved FROM review_items GROUP BY 1")
def review_stats(spark, d):
    return R.review_counts(load(spark, d, "review_items"))


@query("""SELECT entity_id AS canonical_id, round(c, 6) AS confidence, n AS source_count FROM (SELECT entity_id, max(llm_confidence) FILTER (NOT isnan(llm_confidence)) AS c, count(DISTINCT source_url) AS n FROM source_assertions GROUP BY 1) WHERE c >= 0.95 AND n >= 3""")
def seed_promotion(spark, d):
    x = load(spark, d, "source_assertions").groupBy(F.col("entity_id").alias("canonical_id")).agg(F.max(F.when(~F.isnan("llm_confidence"), F.col("llm_confidence"))).alias("confidence"), F.count_distinct("source_url").alias("source_count"))
    return D.promote_seeds(x.withColumn("method", F.lit("fuzzy")).withColumn("is_seed", F.lit(False))).select("canonical_id", F.round("confidence", 6).alias("confidence"), "source_count")


# ---- export -------------------------------------------------------------------------------------------------------


@query("""SELECT record_id, array_to_string(list_filter([CASE WHEN salary_min IS NULL OR salary_min = '' THEN 'schema' END, CASE WHEN verification_status IN ('unverified', 'rejected') THEN 'status' END,
  CASE WHEN coalesce(trim(title), '') = '' OR coalesce(trim(company), '') = '' THEN 'required' END, CASE WHEN canonical_id = 'unknown' THEN 'resolution' END], lambda x: x IS NOT NULL), ',') AS errors FROM jobs""")
def export_gates(spark, d):
    x = load(spark, d, "jobs")
    e = X.export_errors(F.coalesce(F.col("salary_min"), F.lit("")) != "", F.col("verification_status"), [F.col("title"), F.col("company")], F.when(F.col("canonical_id") == "unknown", "unresolved").otherwise("exact"))
    return x.select("record_id", F.array_join(e, ",").alias("errors"))


@query("""SELECT record_id, canonical_id, coalesce(entity_name, '') AS entity_name, 'PAPER' AS record_type, coalesce(title, '') AS title, coalesce(published_date, '') AS published_date, coalesce(citations, '') AS citations
  FROM papers WHERE verification_status IN ('grounded', 'partial') OR (title IS NOT NULL AND coalesce(entity_name, '') NOT IN ('None', ''))""")
def flatten_tab(spark, d):
    x = load(spark, d, "papers").where(X.exportable(F.lit("PAPER"), F.col("verification_status"), F.col("title").isNotNull(), F.col("entity_name")))
    return x.select("record_id", "canonical_id", X.cell(F.col("entity_name")).alias("entity_name"), F.lit("PAPER").alias("record_type"), *[X.cell(F.col(c)).alias(c) for c in ("title", "published_date", "citations")])


@query()
def flatten_lists(spark, d):
    """The export's list cell: packed authors as values joined by "; "."""
    from ..operators.packed_fields import unpack

    x = unpack(load(spark, d, "papers"), ["record_id"], "authors", "always", least=1)
    return x.groupBy("record_id").agg(F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("v")).select("record_id", X.list_cell(F.col("v.item")).alias("authors"))


@query("""SELECT entity_name || '_' || record_id AS canonical_id, entity_name, 'STARTUP' AS record_type, 'exact' AS method, printf('%.3f', 0.5::double) AS confidence, '1' AS sources, 'No' AS is_seed, verification_status AS status, printf('%.2f', 1.0::double) AS ratio, coalesce(source_url, '') AS url FROM startups WHERE entity_name IS NOT NULL""")
def mapping_log(spark, d):
    x = load(spark, d, "startups").where("entity_name IS NOT NULL").select(
        F.concat_ws("_", "entity_name", F.col("record_id").cast("string")).alias("canonical_id"), "entity_name", F.lit("STARTUP").alias("record_type"), F.lit("exact").alias("method"), F.lit(0.5).alias("confidence"), F.lit(1).alias("sources"),
        F.lit(False).alias("is_seed"), F.col("verification_status").alias("status"), F.lit(1.0).alias("ratio"), F.col("source_url").alias("url"),
    )
    return X.mapping_log(x)


@query("SELECT canonical_id AS source, company AS target, 'WORKS_AT' AS relation_type, 0.95::double AS confidence, source_url FROM jobs WHERE trim(company) <> ''")
def implicit_edges(spark, d):
    return X.implicit_edges(load(spark, d, "jobs"))


@query("""SELECT id, CASE WHEN record_type = 'JOB' THEN TRUE ELSE coalesce(split_part(lower(trim(candidate_canonical_id)), '_', 1) = 'startup', FALSE) END AS lax, record_type = 'JOB' AND coalesce(split_part(lower(trim(candidate_canonical_id)), '_', 1) = 'startup', FALSE) AS strict FROM review_items""")
def edge_validity(spark, d):
    t = F.upper(F.coalesce(F.get(F.split(F.lower(F.trim("candidate_canonical_id")), "_"), F.lit(0)), F.lit("")))
    return load(spark, d, "review_items").select("id", X.valid_edge(F.lit("WORKS_AT"), F.col("record_type"), t).alias("lax"), X.valid_edge(F.lit("WORKS_AT"), F.col("record_type"), t, True).alias("strict"))


@query("SELECT assertion_id, entity_id, field_name, substr(value, 1, 500) AS extracted_value, substr(evidence_text, 1, 1000) AS evidence_text, CASE WHEN contains(lower(evidence_text), lower(value)) THEN epoch_us(fetched_at) END AS verified_us FROM source_assertions")
def evidence_chain(spark, d):
    return G.evidence_chain(load(spark, d, "source_assertions"), ["assertion_id", "entity_id", "field_name"])


# ---- texts and pages ----------------------------------------------------------------------------------------------


@query()
def chunk_documents(spark, d):
    return P.chunk_texts(load(spark, d, "documents"), "doc_id", "text", 300, 20)


@query()
def html_meta(spark, d):
    return P.page_parts(load(spark, d, "raw_pages"), "page_id", "payload").select("page_id", "title")


@query()
def html_main_text(spark, d):
    return P.page_parts(load(spark, d, "raw_pages"), "page_id", "payload").select("page_id", F.size("links").alias("links"), "main_text")


@query("SELECT page_id, regexp_matches(payload, '(?i)<(table|dl|ol|ul)\\b|itemtype\\s*=') AS structured FROM raw_pages")
def structured_content(spark, d):
    return load(spark, d, "raw_pages").select("page_id", P.has_structured_content(F.col("payload")).alias("structured"))


@query("SELECT event_id, cast(json_extract(props, '$.k') AS bigint) AS k FROM events")
def json_fields(spark, d):
    return load(spark, d, "events").select("event_id", N.parse_model_json(F.col("props"), "k bigint").getField("k").alias("k"))


@query()
def sanitize_text(spark, d):
    x = load(spark, d, "documents").where("text IS NOT NULL")
    return x.select("doc_id", N.sanitize_text(F.col("text")).alias("clean"))


# ---- extraction, crawling -----------------------------------------------------------------------------------------


@query("""SELECT record_id, array_to_string(list_filter([CASE WHEN coalesce(trim(title), '') = '' THEN 'title:required' END, CASE WHEN coalesce(trim(citations), '') <> '' AND try_cast(citations AS double) IS NULL THEN 'citations:numeric' END,
  CASE WHEN coalesce(trim(citations), '') <> '' AND NOT coalesce(try_cast(citations AS double) BETWEEN 0 AND 1000000, FALSE) THEN 'citations:range' END, CASE WHEN coalesce(trim(published_date), '') <> '' AND NOT regexp_matches(published_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') THEN 'published_date:pattern' END,
  CASE WHEN coalesce(trim(verification_status), '') <> '' AND verification_status NOT IN ('grounded', 'partial', 'unverified', 'rejected') THEN 'verification_status:one_of' END], lambda x: x IS NOT NULL), ',') AS errors FROM papers""")
def schema_validation(spark, d):
    rules = [("title", "required", None), ("citations", "numeric", None), ("citations", "range", (0, 1_000_000)), ("published_date", "pattern", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), ("verification_status", "one_of", ["grounded", "partial", "unverified", "rejected"])]
    return load(spark, d, "papers").select("record_id", F.array_join(E.schema_errors(rules), ",").alias("errors"))


@query("SELECT event_id, 'k' AS field_name, CAST(NULL AS int) AS idx, json_extract_string(props, '$.k') AS value, 0.0::double AS confidence FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def model_fields(spark, d):
    return E.evidenced_fields(load(spark, d, "events"), "event_id", "props").select("event_id", "field_name", "idx", "value", "confidence")


@query("""SELECT source_name, sum(length(url) // 4)::bigint AS tokens, round(sum(length(url) // 4) / 1000.0 * 0.000075 + count(*) * 100 / 1000.0 * 0.0003, 6) AS cost FROM queue_messages WHERE url IS NOT NULL GROUP BY 1""")
def cost_by_source(spark, d):
    x = load(spark, d, "queue_messages").where("url IS NOT NULL").groupBy("source_name").agg(F.sum(F.floor(F.length("url") / 4)).alias("tokens"), F.count(F.lit(1)).alias("n"))
    return x.select("source_name", "tokens", F.round(E.cost(F.lit("gemini"), F.col("tokens"), F.col("n") * 100), 6).alias("cost"))


@query("""SELECT manifest_id, least(60.0, CASE WHEN status_code = 429 THEN 5.0 ELSE pow(2.0, fetch_tier) END)::double AS wait, CASE WHEN status_code BETWEEN 200 AND 399 THEN 'ok' WHEN status_code = 429 THEN 'rate_limited' WHEN status_code BETWEEN 500 AND 599 THEN 'server_error' ELSE 'failed' END AS response,
  NOT (contains(url, '/p/') AND regexp_matches(url, '^[a-zA-Z]+://[^/?#]*/p/')) AS allowed FROM crawl_manifests WHERE url IS NOT NULL""")
def crawl_policy(spark, d):
    x = load(spark, d, "crawl_manifests").where("url IS NOT NULL")
    hosts = load(spark, d, "source_registry").select("host")
    rules = hosts.select("host", F.lit("/p/").alias("path"), F.lit(False).alias("allow")).unionAll(hosts.select("host", F.lit("/").alias("path"), F.lit(True).alias("allow")))
    x = C.robots_allowed(x.select("manifest_id", "url", "status_code", "fetch_tier"), rules)
    return x.select("manifest_id", C.retry_wait(F.col("fetch_tier"), F.when(F.col("status_code") == 429, F.lit(5.0))).alias("wait"), C.response_class(F.col("status_code")).alias("response"), "allowed")


@query("""SELECT p.page_id, trim(p.url) AS url, CASE WHEN contains(payload, trim(p.url)) THEN 1.0 WHEN contains(payload, regexp_replace(trim(p.url), '^[a-zA-Z]+://', '')) THEN 0.95 ELSE 0.0 END::double AS score FROM raw_pages p WHERE p.url IS NOT NULL AND payload IS NOT NULL""")
def url_in_source(spark, d):
    u = F.trim("url")
    s = F.when(F.contains("payload", u), 1.0).when(F.contains("payload", F.regexp_replace(u, r"^[a-zA-Z]+://", "")), 0.95).otherwise(0.0)
    return load(spark, d, "raw_pages").where("url IS NOT NULL AND payload IS NOT NULL").select("page_id", u.alias("url"), s.alias("score"))


@query("""SELECT record_id, entity_name FROM (SELECT record_id, entity_name, row_number() OVER (ORDER BY updated_at NULLS FIRST, record_id) AS r FROM startups WHERE verification_status IN ('grounded', 'partial')) WHERE r > 50 AND r <= 150""")
def export_page(spark, d):
    """The export's second page: 100 rows in order of update; paging is the feature."""
    return D.page(load(spark, d, "startups").where("verification_status IN ('grounded', 'partial')"), ["updated_at", "record_id"], 50, 100).select("record_id", "entity_name")


@query("""SELECT canonical_id, company, source_url FROM jobs WHERE canonical_id = (SELECT min(canonical_id) FROM jobs) OR company = (SELECT min(company) FROM jobs WHERE company <> '')""")
def edges_of(spark, d):
    """Edges with a given source or target."""
    x = load(spark, d, "jobs")
    a, b = x.agg(F.min("canonical_id"), F.min(F.when(F.col("company") != "", F.col("company")))).first()
    return D.edges_at(x, "canonical_id", "company", a, b).select("canonical_id", "company", "source_url")


@query(f"WITH {_VOTED} SELECT entity_id, array_to_string(list_sort(list(field_name || '=' || winner)), ';') AS winners, count(*) FILTER (contested) AS dissent FROM votes GROUP BY 1")
def winners_map(spark, d):
    v = V.vote_fields(_scored(spark, d))
    return v.groupBy("entity_id").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "field_name", "winner"))), ";").alias("winners"), F.count_if("contested").alias("dissent"))


@query()
def page_metadata(spark, d):
    pages = load(spark, d, "raw_pages")
    return E.page_metadata(P.page_parts(pages, "page_id", "payload").join(pages.select("page_id", "url"), "page_id"), "page_id", "url")


@query("SELECT doc_id AS record_id, source AS field_name, min(n_chars) AS value, 0 AS chunk_index FROM documents WHERE n_chars IS NOT NULL AND source IS NOT NULL GROUP BY 1, 2")
def chunk_merge(spark, d):
    x = load(spark, d, "documents").where("source IS NOT NULL").select(F.col("doc_id").alias("record_id"), F.col("source").alias("field_name"), F.lit(0).alias("chunk_index"), F.col("n_chars").alias("value"))
    return E.merge_chunks(x)


@query("""SELECT parsed_id, cast(min(d) AS varchar) AS first_day, count(d) AS dates FROM (SELECT parsed_id, unnest(list_filter(list_concat(
  list_transform(regexp_extract_all(raw, '\\d{4}-\\d{2}-\\d{2}'), lambda x: try_strptime(x, '%Y-%m-%d')), list_transform(regexp_extract_all(raw, '(?:January|February|March|April|May|June|July|August|September|October|November|December) \\d{1,2}, \\d{4}'), lambda x: try_strptime(x, '%B %-d, %Y')),
  list_transform(regexp_extract_all(raw, '\\d{1,2} (?:January|February|March|April|May|June|July|August|September|October|November|December) \\d{4}'), lambda x: try_strptime(x, '%-d %B %Y'))), lambda x: x IS NOT NULL AND year(x) > 0))::date AS d FROM parsed_dates WHERE raw IS NOT NULL) GROUP BY 1""")
def dates_in_text(spark, d):
    x = load(spark, d, "parsed_dates").where("raw IS NOT NULL").withColumn("ds", DT.dates_in(F.col("raw"))).where(F.size("ds") > 0)
    return x.select("parsed_id", F.array_min("ds").cast("string").alias("first_day"), F.size("ds").cast("long").alias("dates"))


@query(f"SELECT doc_id FROM documents WHERE epoch_us(TIMESTAMPTZ '{NOW}+00') - epoch_us(fetched_at) <= 720 * 3600e6")
def fresh_documents(spark, d):
    return load(spark, d, "documents").where(DT.within_hours(F.col("fetched_at"), NOW, 720)).select("doc_id")


@query("SELECT entity_id AS record_id, field_name, count(*) AS items, round(avg(CASE WHEN ok THEN 100.0 ELSE 0.0 END) + 1e-9, 4) AS score, avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END) >= 0.5 AS grounded FROM (SELECT entity_id, field_name, contains(lower(evidence_text), lower(value)) AS ok FROM source_assertions WHERE value IS NOT NULL AND evidence_text IS NOT NULL) GROUP BY 1, 2")
def list_grounding(spark, d):
    ok = F.contains(F.lower("evidence_text"), F.lower("value"))
    x = load(spark, d, "source_assertions").where("value IS NOT NULL AND evidence_text IS NOT NULL").select(F.col("entity_id").alias("record_id"), "field_name", F.when(ok, 100.0).otherwise(0.0).alias("grounding"), F.when(ok, "GROUNDED").otherwise("UNVERIFIED").alias("status"))
    return G.list_grounding(x)
