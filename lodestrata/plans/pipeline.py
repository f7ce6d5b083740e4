"""Queries over verification, messages, export tabs, stores and reports, on the whole test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates as DT
from ..functions import names as N
from ..functions import pages as P
from ..functions import urls as U
from ..operators import export as X
from ..operators import extraction as E
from ..operators import messages as M
from ..operators import reports as RP
from ..operators import resolve as R
from ..operators import scoring as S
from ..operators import upserts as D
from ..operators import verify as Y
from ..operators import voting as V
from ..session import load, shared_dir, stage
from ..sources import listings as L
from ..sources import stores as T
from .reference import _NUMS, _QUALITY, _SEEDS_SQL, _VOTED, NOW, _fields, _FIELDS_SQL, _fresh, _FRESH, _quality, _scored, _seeds

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _own(spark, name: str) -> str:
    return f"{shared_dir(spark)}/lodestrata/{name}-{uuid.uuid4().hex}"


# ---- verification -------------------------------------------------------------------------------------------------

_FIRST = "list_extract({0}, 1)"


@query(f"""WITH {_FIELDS_SQL}, n AS (SELECT record_id, field_name, {_FIRST.format(_NUMS.replace("@", "value"))} AS x, list_concat({_NUMS.replace("@", "evidence")}, {_NUMS.replace("@", "source")}) AS told FROM fl WHERE field_name IN ('fundingTotal', 'employeeCount')),
  h AS (SELECT *, list_extract(list_filter(list_transform(list_filter(told, lambda v: v <> 0), lambda v: abs(x - v) / abs(v)), lambda r: r <= 0.01), 1) AS hit FROM n)
  SELECT record_id, field_name, CASE WHEN x IS NULL THEN 'MISSING' WHEN hit IS NOT NULL THEN 'GROUNDED' ELSE 'UNVERIFIED' END AS status, CASE WHEN x IS NULL OR hit IS NULL THEN 0.0 ELSE round(1 - hit, 9) END::double AS score FROM h""")
def numeric_verifier(spark, d):
    x = _fields(spark, d).where("field_name IN ('fundingTotal', 'employeeCount')")
    return x.select("record_id", "field_name", Y.verify_number(F.col("value"), F.col("evidence"), F.col("source")).alias("r")).select("record_id", "field_name", "r.*")


@query("""SELECT assertion_id, CASE WHEN u IS NULL OR trim(u) = '' THEN 'MISSING' WHEN contains(s, u) OR contains(s, b) THEN 'GROUNDED' ELSE 'UNVERIFIED' END AS status,
    CASE WHEN u IS NULL OR trim(u) = '' THEN 0.0 WHEN contains(s, u) THEN 1.0 WHEN contains(s, b) THEN 0.95 ELSE 0.0 END::double AS score
  FROM (SELECT assertion_id, lower(source_url) AS u, regexp_replace(lower(source_url), 'https?://', '', 'g') AS b, lower(coalesce(evidence_text, '') || ' ' || CASE WHEN assertion_id % 3 = 0 THEN source_url WHEN assertion_id % 3 = 1 THEN regexp_replace(source_url, '^https?://', '') ELSE '' END) AS s
        FROM source_assertions WHERE source_url IS NOT NULL AND regexp_matches(source_url, '^https?://[a-z0-9.-]+/[a-z0-9/_.-]*[a-z0-9]$'))""")
def url_verifier(spark, d):
    """Addresses in clean spelling against a source that has them whole, without scheme, or not."""
    x = load(spark, d, "source_assertions").where(r"source_url IS NOT NULL AND source_url RLIKE '^https?://[a-z0-9.-]+/[a-z0-9/_.-]*[a-z0-9]$'")
    k = F.col("assertion_id") % 3
    s = F.concat(F.coalesce("evidence_text", F.lit("")), F.lit(" "), F.when(k == 0, F.col("source_url")).when(k == 1, F.regexp_replace("source_url", r"^https?://", "")).otherwise(""))
    return x.select("assertion_id", Y.verify_url(F.col("source_url"), s).alias("r")).select("assertion_id", "r.*")


@query()
def verified_fields(spark, d):
    """Every rule-based field by the verifier of its class; ratios have no SQL, tests hold them against brute force."""
    return Y.verify_fields(_fields(spark, d)).select("record_id", "field_name", "status", "score")


@query(f"""WITH {_VOTED} SELECT entity_id, count(*) AS fields, round(count(*) FILTER (NOT contested AND confidence >= 0.3) / count(*), 6) AS ratio,
  CASE WHEN bool_or(contested AND consensus < 0.4) THEN 'rejected' WHEN bool_and(NOT contested AND confidence >= 0.3) THEN 'grounded' WHEN count(*) FILTER (NOT contested AND confidence >= 0.3) / count(*) >= 0.5 THEN 'partial' ELSE 'unverified' END AS verdict FROM votes GROUP BY 1""")
def record_verdicts(spark, d):
    v = V.vote_fields(_scored(spark, d))
    s = F.when(F.col("contested") & (F.col("consensus") < 0.4), "CONFLICTING").when(~F.col("contested") & (F.col("confidence") >= 0.3), "GROUNDED").otherwise("UNVERIFIED")
    return Y.record_verdict(v.withColumn("status", s), "entity_id")


# ---- messages -----------------------------------------------------------------------------------------------------

_MSG = ("entry_id", "message_id", "correlation_id", "attempt", "max_attempts", "source_worker", "url", "source_name", "record_type", "listing_page", "fetch_tier", "priority")


@query(f"SELECT {', '.join('coalesce(attempt, -1) AS attempt' if c == 'attempt' else c for c in _MSG)} FROM queue_messages")
def message_codec(spark, d):
    """Every message through its JSON text and back."""
    x = load(spark, d, "queue_messages").select(*_MSG)
    return M.decode(M.encode(x), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in x.schema.fields)).fillna(-1, ["attempt"])


@query(f"""SELECT entry_id, idle >= 300000 AS claimed, coalesce(attempt, 0) + CASE WHEN idle >= 300000 THEN 1 ELSE 0 END AS next_attempt,
  CASE WHEN idle IS NULL OR idle < 300000 THEN 'wait' WHEN coalesce(attempt, 0) + 1 >= coalesce(max_attempts, 5) THEN 'dead_letter' ELSE 'retry' END AS route
  FROM (SELECT *, floor((epoch_us(TIMESTAMPTZ '2024-08-01 00:00:00+00') - epoch_us(received_at)) / 1000) AS idle FROM queue_messages WHERE received_at IS NOT NULL)""")
def stale_claims(spark, d):
    x = load(spark, d, "queue_messages").where("received_at IS NOT NULL")
    return M.claim_stale(x, F.lit("2024-08-01 00:00:00").cast("timestamp")).select("entry_id", "claimed", "next_attempt", "route")


@query("""SELECT source_worker, count(*) AS depth, CASE WHEN count(*) >= 1000 THEN 'hold' WHEN count(*) <= 500 THEN 'release' ELSE 'steady' END AS pressure FROM queue_messages GROUP BY 1""")
def queue_depths(spark, d):
    return M.queue_depth(load(spark, d, "queue_messages"), "source_worker", 1000, 500)


_STATES = """st AS (SELECT record_type AS kind, source_name AS provider, source_name AS pos, CASE WHEN avg(CASE WHEN attempt >= 2 THEN 1.0 ELSE 0.0 END) > 0.1 THEN 'OPEN' ELSE 'CLOSED' END AS state FROM queue_messages WHERE record_type IS NOT NULL AND source_name IS NOT NULL GROUP BY 1, 2)"""


@query(f"""WITH {_STATES}, p AS (SELECT kind, arg_min(provider, pos) FILTER (state <> 'OPEN') AS usable, arg_min(state, pos) AS first_state, arg_min(provider, pos) AS first FROM st GROUP BY 1)
  SELECT entry_id, CASE WHEN priority = 0 THEN CASE WHEN first_state <> 'OPEN' THEN first END ELSE usable END AS provider FROM queue_messages LEFT JOIN p ON p.kind = record_type""")
def provider_fallback(spark, d):
    """The provider of each message: sources stand for providers, open where more than a tenth of their messages were retried."""
    x = load(spark, d, "queue_messages")
    st = x.where("record_type IS NOT NULL AND source_name IS NOT NULL").groupBy(F.col("record_type").alias("kind"), F.col("source_name").alias("provider")).agg(F.avg((F.coalesce("attempt", F.lit(0)) >= 2).cast("double")).alias("r"))
    st = st.select("kind", "provider", F.col("provider").alias("pos"), F.when(F.col("r") > 0.1, "OPEN").otherwise("CLOSED").alias("state"))
    r = x.select("entry_id", F.col("record_type").alias("kind"), F.when(F.col("priority") == 0, "saving").otherwise("any").alias("mode"))
    return M.choose_provider(r, st).select("entry_id", "provider")


@query("""WITH r AS (SELECT host, 0.002 + 0.001 * length(host) AS own FROM source_registry WHERE host IS NOT NULL GROUP BY 1), m AS (SELECT manifest_id, host, epoch_us(fetched_at) / 1e6 AS t, coalesce(own, 0.01) AS rate FROM (SELECT manifest_id, fetched_at, source_name AS host FROM crawl_manifests WHERE fetched_at IS NOT NULL AND source_name IS NOT NULL) LEFT JOIN r USING (host)),
  j AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY t, manifest_id) - 1 AS j FROM m), g AS (SELECT *, max(t - j / rate) OVER (PARTITION BY host ORDER BY t, manifest_id ROWS UNBOUNDED PRECEDING) AS top FROM j)
  SELECT manifest_id, round(greatest(0.0, top + (j + 1 - greatest(rate, 1.0)) / rate - t), 3) AS wait FROM g""")
def throttle_waits(spark, d):
    """Seconds each fetch has to wait under its source's bucket; the registry overrides the rate where a source bears a host's name."""
    rates = load(spark, d, "source_registry").where("host IS NOT NULL").select("host").distinct().withColumn("rate", 0.002 + 0.001 * F.length("host"))
    x = load(spark, d, "crawl_manifests").where("fetched_at IS NOT NULL AND source_name IS NOT NULL").select("manifest_id", F.col("source_name").alias("host"), "fetched_at")
    return M.throttle(x, "host", "fetched_at", "manifest_id", rates, 0.01).select("manifest_id", F.round("wait", 3).alias("wait"))


@query("SELECT record_type, (count(*) + 499) // 500 AS batches, count(*) AS messages FROM queue_messages WHERE record_type IS NOT NULL GROUP BY 1")
def enqueue_batches(spark, d):
    """Messages in batches of 500 by type: how many batches there are, and that none is larger."""
    x = M.batches(load(spark, d, "queue_messages").where("record_type IS NOT NULL"), "record_type", ["entry_id"])
    b = x.groupBy("record_type", "batch").agg(F.count(F.lit(1)).alias("n"))
    return b.groupBy("record_type").agg(F.count(F.lit(1)).alias("batches"), F.sum(F.when(F.col("n") <= 500, F.col("n"))).alias("messages"))


@query("SELECT count(*) AS marked, (count(*) + 499) // 500 AS batches FROM startups WHERE updated_at IS NULL OR verification_status = 'grounded'")
def export_flush(spark, d):
    x = load(spark, d, "startups").select("record_id", F.when(F.col("verification_status") == "grounded", F.lit(None)).otherwise(F.col("updated_at")).alias("exported_at"))
    return X.mark_batches(x, "record_id", NOW).agg(F.count("exported_at").alias("marked"), F.count_distinct("batch").alias("batches"))


# ---- export tabs --------------------------------------------------------------------------------------------------


def _tab_sql(table: str, kind: str, fields: dict[str, str]) -> str:
    common = f"""coalesce(canonical_id, '') AS "Canonical ID", coalesce(entity_name, '') AS "Entity Name", '{kind}' AS "Record Type", coalesce(verification_status, '') AS "Verification Status", coalesce(source_url, '') AS "Source URL\""""
    return f"SELECT {common}, " + ", ".join(f"""{f"coalesce(CAST({fields[k]} AS varchar), '')" if k in fields else "''"} AS "{h}\"""" for k, h in X.COLUMNS[kind].items()) + f" FROM {table}"


_TAB = {
    "startups": ("STARTUP", {"foundedDate": "founded_date", "headquarters": "headquarters", "industry": "industry", "employeeCount": "employee_count", "investors": "investors"}),
    "papers": ("PAPER", {"title": "title", "authors": "authors", "publishedDate": "published_date", "categories": "category", "citations": "citations"}),
    "jobs": ("JOB", {"title": "title", "company": "company", "location": "location", "salaryMin": "salary_min", "skills": "skills"}),
}


def _tab(table: str):
    kind, fields = _TAB[table]

    def run(spark, d):
        return X.tab_rows(load(spark, d, table), kind, {k: F.col(c) for k, c in fields.items()})

    run.__name__ = f"tab_{table}"
    run.__doc__ = f"The export tab of {table}, with all its columns."
    return query(_tab_sql(table, kind, fields))(run)


tab_startups, tab_papers, tab_jobs = map(_tab, _TAB)


@query("SELECT 'Jobs' AS tab, count(*) AS n, count(DISTINCT title) AS titles FROM jobs UNION ALL SELECT 'Papers', count(*), count(DISTINCT title) FROM papers")
def export_tabs(spark, d):
    """Tabs written as CSV with headers, and read back."""
    path = _own(spark, "tabs")
    T.write_tabs({X.TABS[k]: load(spark, d, t).select(F.col("title").alias("Title"), X.cell(F.col("canonical_id")).alias("Canonical ID")) for t, (k, _) in _TAB.items() if t != "startups"}, path)
    read = lambda t: spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{path}/{t}").select(F.lit(t).alias("tab"), "Title")
    x = read("Jobs").unionAll(read("Papers"))
    return x.groupBy("tab").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Title").alias("titles"))


@query("""SELECT id, candidate_canonical_id AS canonical_id, resolution_method AS method, printf('%.3f', round(similarity_score, 9)) AS confidence, CAST(n AS varchar) AS sources, CASE WHEN n >= 3 THEN 'Yes' ELSE 'No' END AS is_seed
  FROM (SELECT *, count(*) OVER (PARTITION BY candidate_canonical_id) AS n FROM review_items WHERE candidate_canonical_id IS NOT NULL) WHERE resolution_method <> 'unresolved' AND similarity_score IS NOT NULL AND NOT isnan(similarity_score)""")
def mapping_log_reviews(spark, d):
    """Log rows of all reviewed pairs: how each was resolved, how surely, and how often its candidate was met."""
    x = load(spark, d, "review_items").where("candidate_canonical_id IS NOT NULL")
    n = x.groupBy("candidate_canonical_id").agg(F.count(F.lit(1)).alias("sources"))
    x = x.where("similarity_score IS NOT NULL AND NOT isnan(similarity_score) AND resolution_method <> 'unresolved'").join(n, "candidate_canonical_id")
    return x.select("id", F.col("candidate_canonical_id").alias("canonical_id"), F.col("resolution_method").alias("method"), F.format_string("%.3f", F.round("similarity_score", 9)).alias("confidence"), F.col("sources").cast("string").alias("sources"), F.when(F.col("sources") >= 3, "Yes").otherwise("No").alias("is_seed"))


@query("""SELECT canonical_id AS source, trim(p) AS target, 'BUILDS_PRODUCT' AS relation_type, 0.8 AS confidence FROM (SELECT canonical_id, unnest([industry, headquarters]) AS p FROM startups) WHERE trim(p) <> ''
  UNION ALL SELECT canonical_id, company, 'WORKS_AT', 0.95 FROM jobs WHERE trim(company) <> ''""")
def implied_edges(spark, d):
    """Both kinds of implied edges; the startups' text columns stand for lists of products, which the test tables lack."""
    s = load(spark, d, "startups").select("canonical_id", F.filter(F.transform(F.array("industry", "headquarters"), lambda x: F.trim(x)), lambda x: x != "").alias("products"), "source_url")
    return X.implicit_edges(load(spark, d, "jobs"), s).select("source", "target", "relation_type", "confidence")


# ---- stores and sources -------------------------------------------------------------------------------------------


@query("SELECT record_id, field_name, value FROM (WITH " + _FIELDS_SQL + " SELECT * FROM fl) WHERE value IS NOT NULL")
def evidence_append(spark, d):
    """Evidence rows appended in two loads, and read back."""
    path = _own(spark, "evidence")
    x = _fields(spark, d)
    for half in (0, 1):
        T.append_evidence(x.where(F.col("record_id") % 2 == half), path)
    return spark.read.parquet(path).where("value IS NOT NULL").select("record_id", "field_name", "value")


@query("""SELECT page_id, source_name, epoch_us(fetched_at) AS at_us, length(payload) AS size FROM raw_pages JOIN crawl_manifests USING (raw_s3_key) WHERE source_name IS NOT NULL AND fetched_at IS NOT NULL""")
def raw_store(spark, d):
    """Payloads through the raw store, partitioned by source and day."""
    path = _own(spark, "raw")
    m = load(spark, d, "crawl_manifests").where("raw_s3_key IS NOT NULL AND source_name IS NOT NULL AND fetched_at IS NOT NULL").select("raw_s3_key", "source_name", "fetched_at", "content_hash", "content_type")
    p = load(spark, d, "raw_pages").select("page_id", "raw_s3_key", "payload").join(m, "raw_s3_key").drop("raw_s3_key")
    T.write_raw(p.repartition("source_name"), path)
    return T.read_raw(spark, path).select("page_id", F.col("source_name").cast("string").alias("source_name"), F.unix_micros("fetched_at").alias("at_us"), F.length("payload").alias("size"))


@query("SELECT count(*) AS requests, count(*) FILTER (k % 2 = 1 OR k % 5 = 0) AS uncached FROM (SELECT DISTINCT manifest_id AS k FROM documents WHERE manifest_id IS NOT NULL)")
def cache_roundtrip(spark, d):
    """Answers for even manifests are cached, those divisible by five two days ago: the rest must be asked again."""
    path = _own(spark, "cache")
    r = load(spark, d, "documents").where("manifest_id IS NOT NULL").select("manifest_id").distinct().withColumn("cache_key", N.cache_key(F.col("manifest_id").cast("string"), F.lit("m"), F.lit("STARTUP")))
    even = r.where("manifest_id % 2 = 0").withColumn("answer", F.lit("{}"))
    T.cache_answers(even.where("manifest_id % 5 <> 0"), path, "2024-11-14 12:00:00")
    T.cache_answers(even.where("manifest_id % 5 = 0"), path, "2024-11-13 00:00:00")
    left = T.uncached(r, spark.read.parquet(path), NOW)
    return r.agg(F.count(F.lit(1)).alias("requests")).join(left.agg(F.count(F.lit(1)).alias("uncached")), F.lit(True))


@query(f"WITH {_SEEDS_SQL} SELECT canonical_id, name AS entity_name, record_type, 'grounded' AS status, true AS is_seed FROM sd WHERE record_type = 'STARTUP'")
def seed_load(spark, d):
    """Seeds of one type through a JSON file into entities."""
    path = _own(spark, "seeds")
    R.seeds_of_type(_seeds(spark, d), "STARTUP").select("canonical_id", "name", "record_type", "aliases").write.json(path)
    return T.seed_entities(T.read_seeds(spark, path, lines=True)).select("canonical_id", "entity_name", "record_type", "status", "is_seed")


@query(f"WITH {_SEEDS_SQL} SELECT canonical_id, name FROM sd WHERE canonical_id IN (SELECT lower(trim(candidate_canonical_id)) FROM review_items WHERE status = 'resolved')")
def seeds_by_id(spark, d):
    ids = load(spark, d, "review_items").where("status = 'resolved'").select(F.lower(F.trim("candidate_canonical_id")).alias("canonical_id"))
    return R.seeds_by_id(_seeds(spark, d), ids).select("canonical_id", "name")


@query(f"WITH {_SEEDS_SQL} SELECT record_type, count(*) AS seeds, count(DISTINCT lower(name)) AS names FROM sd GROUP BY 1")
def seed_counts(spark, d):
    return _seeds(spark, d).groupBy("record_type").agg(F.count(F.lit(1)).alias("seeds"), F.count_distinct(F.lower("name")).alias("names"))


@query()
def edge_endpoints(spark, d):
    """The reviews' names as ends of edges, each resolved against the seeds."""
    e = load(spark, d, "review_items").where("extracted_name IS NOT NULL AND candidate_name IS NOT NULL").select("id", F.col("extracted_name").alias("source"), F.col("candidate_name").alias("target"), "record_type")
    return R.edge_endpoints(e, _seeds(spark, d)).select("id", "source_id", "target_id")


@query("SELECT record_id, source_url AS url FROM jobs WHERE source_url IS NOT NULL AND NOT contains(source_url, '\"') AND NOT contains(source_url, '\\')")
def json_listing(spark, d):
    """Jobs as items of a JSON listing, and their addresses out of it."""
    x = load(spark, d, "jobs").where("source_url IS NOT NULL AND NOT contains(source_url, '\"') AND NOT contains(source_url, '\\\\')").select("record_id", F.to_json(F.struct(F.array(F.struct(F.col("source_url").alias("url"))).alias("jobs"))).alias("payload"))
    return L.json_urls(x, "record_id", "payload")


@query("SELECT record_id, title FROM papers WHERE regexp_matches(lower(coalesce(title, '') || ' ' || coalesce(category, '')), 'startup|ai |raises|funding|launch')")
def keyword_filter(spark, d):
    return L.keyword_entries(load(spark, d, "papers"), "title", "category").select("record_id", "title")


@query("""SELECT source_name, listing_page, entry_id FROM (SELECT *, row_number() OVER (PARTITION BY source_name, listing_page ORDER BY entry_id) AS r FROM (SELECT source_name, listing_page, entry_id FROM queue_messages WHERE listing_page IS NOT NULL AND source_name IS NOT NULL)) WHERE r <= 10""")
def listing_cap(spark, d):
    """The first ten entries of each listing page: a listing's own limit."""
    x = load(spark, d, "queue_messages").where("listing_page IS NOT NULL AND source_name IS NOT NULL").withColumn("page", F.struct("source_name", "listing_page"))
    return L.top_per_page(x, "page", "entry_id", 10).select("source_name", "listing_page", "entry_id")


# ---- extraction ---------------------------------------------------------------------------------------------------


@query()
def paper_fields(spark, d):
    pages = load(spark, d, "raw_pages")
    return E.paper_metadata(P.page_parts(pages, "page_id", "payload").join(pages.select("page_id", "url"), "page_id"), "page_id", "url")


@query()
def page_fields(spark, d):
    pages = load(spark, d, "raw_pages")
    return E.page_fields(P.page_parts(pages, "page_id", "payload").join(pages.select("page_id", "url"), "page_id"), "page_id", "url")


@query("SELECT record_id, CASE WHEN k = 0 THEN title WHEN k = 1 THEN title WHEN k = 2 THEN title END AS title, CASE k WHEN 0 THEN 'object' WHEN 1 THEN 'object' WHEN 2 THEN 'list' ELSE 'none' END AS form FROM (SELECT record_id, title, record_id % 4 AS k FROM papers WHERE title IS NOT NULL)")
def answer_forms(spark, d):
    """Answers as models write them: fenced, with talk around, as a list, or none; one title each."""
    x = load(spark, d, "papers").where("title IS NOT NULL").withColumn("k", F.col("record_id") % 4).withColumn("o", F.to_json(F.struct("title")))
    text = F.when(F.col("k") == 0, F.concat(F.lit("```json\n"), "o", F.lit("\n```"))).when(F.col("k") == 1, F.concat(F.lit("Here it is: "), "o", F.lit(" as asked."))).when(F.col("k") == 2, F.concat(F.lit(" ["), "o", F.lit("] "))).otherwise("no answer")
    v = x.select("record_id", E.read_answer(text).alias("v"))
    one, many = F.try_variant_get("v", "$.title", "string"), F.try_variant_get("v", "$.items[0].title", "string")
    return v.select("record_id", F.coalesce(one, many).alias("title"), F.when(one.isNotNull(), "object").when(many.isNotNull(), "list").otherwise("none").alias("form"))


@query("""SELECT doc_id AS record_id, field_name, arg_min(value, chunk_index) AS value, min(chunk_index) AS chunk_index FROM (SELECT doc_id, 'title' AS field_name, i - 1 AS chunk_index, w[i] AS value FROM (SELECT doc_id, regexp_split_to_array(text, '\\n\\n+') AS w, unnest(range(1, len(regexp_split_to_array(text, '\\n\\n+')) + 1)) AS i FROM documents WHERE text IS NOT NULL)) WHERE length(value) > 40 GROUP BY 1, 2""")
def chunk_merge_parts(spark, d):
    """A field read from each paragraph of a text: the first paragraph of some length wins."""
    x = load(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("record_id"), F.posexplode(F.split("text", r"\n\n+")).alias("chunk_index", "p"))
    return E.merge_chunks(x.select("record_id", F.lit("title").alias("field_name"), "chunk_index", F.when(F.length("p") > 40, F.col("p")).alias("value")))


@query()
def layered_dates(spark, d):
    x = load(spark, d, "parsed_dates").where("raw IS NOT NULL AND fetched_at IS NOT NULL").select("parsed_id", DT.layered_date(F.col("raw"), F.col("fetched_at")).alias("r")).where("r IS NOT NULL")
    return x.select("parsed_id", F.unix_micros("r.value").alias("utc_us"), "r.confidence", "r.layer")


_AGO = "try_cast(regexp_extract(raw, '(?i)(\\d+)\\s*{0}s?\\s*ago', 1) AS bigint)"


@query("SELECT parsed_id, epoch_us(fetched_at) - 1000000 * coalesce(" + ", ".join(f"{_AGO.format(u)} * {n}" for u, n in DT.AGO.items()) + """, CASE WHEN regexp_matches(raw, '(?i)\\byesterday\\b') THEN 86400 WHEN regexp_matches(raw, '(?i)\\btoday\\b|\\bjust\\s*now\\b') THEN 0 END) AS utc_us
  FROM parsed_dates WHERE fetched_at IS NOT NULL AND raw IS NOT NULL AND regexp_matches(raw, '(?i)\\d\\s*(second|minute|hour|day|week|month|year)s?\\s*ago|\\byesterday\\b|\\btoday\\b|\\bjust\\s*now\\b')""")
def relative_dates(spark, d):
    x = load(spark, d, "parsed_dates").where("raw IS NOT NULL AND fetched_at IS NOT NULL")
    return x.select("parsed_id", F.unix_micros(DT.relative_date(F.col("raw"), F.col("fetched_at"))).alias("utc_us")).where("utc_us IS NOT NULL")


@query("SELECT doc_id, length(text) AS content, contains(text, '{content}') AS tricky FROM documents WHERE text IS NOT NULL")
def prompt_texts(spark, d):
    """Every text in the prompt of its type: what a prompt is longer by than its template is the text."""
    x = load(spark, d, "documents").where("text IS NOT NULL").withColumn("p", E.prompts(F.col("record_type"), F.col("text"))).withColumn("bare", E.prompts(F.col("record_type"), F.lit("")))
    return x.select("doc_id", (F.length("p") - F.length("bare")).alias("content"), F.contains(F.col("text"), F.lit("{content}")).alias("tricky"))


# ---- reports and metrics ------------------------------------------------------------------------------------------


@query("""SELECT source_name, unnest(['fetches', 'failed', 'bytes']) AS metric, unnest([count(*), count(*) FILTER (status_code >= 400), coalesce(sum(content_length), 0)])::double AS value FROM crawl_manifests GROUP BY 1""")
def run_metrics(spark, d):
    x = load(spark, d, "crawl_manifests")
    return RP.labelled(x, ["source_name"], fetches=F.count(F.lit(1)), failed=F.count_if(F.col("status_code") >= 400), bytes=F.coalesce(F.sum("content_length"), F.lit(0)))


@query("SELECT count(*) AS messages, count(*) FILTER (attempt > 1) AS retried, max(priority) AS top FROM queue_messages")
def observed_metrics(spark, d):
    """Counters taken while a table is written, not by a scan of their own."""
    x, o = RP.observed(load(spark, d, "queue_messages"), f"messages-{uuid.uuid4().hex}", messages=F.count(F.lit(1)), retried=F.count_if(F.col("attempt") > 1), top=F.max("priority"))
    x.select("entry_id").write.parquet(_own(spark, "observed"))
    got = o.get
    return spark.createDataFrame([(got["messages"], got["retried"], got["top"])], "messages long, retried long, top int")


@query(f"""WITH {_FRESH} SELECT d.record_type, count(*) FILTER (level = 'fresh') AS fresh, count(*) FILTER (level = 'aging') AS aging, count(*) FILTER (level = 'stale') AS stale, count(*) FILTER (level = 'critical') AS critical, count(*) FILTER (level IN ('stale', 'critical')) > 0 AS due FROM f2 JOIN documents d USING (doc_id) GROUP BY 1""")
def recrawl_levels(spark, d):
    return RP.level_counts(_fresh(spark, d))


@query()
def lineage_reports(spark, d):
    sc = _scored(spark, d)
    v = V.vote_fields(sc)
    from ..operators import grounding as G

    return RP.lineage_json(v, G.lineage_traces(v, sc))


_DIMS = ["source_diversity", "grounding", "consensus", "trust", "completeness", "freshness"]


@query(f"""WITH {_QUALITY} SELECT entity_id, CASE WHEN score >= 90 THEN 'A' WHEN score >= 75 THEN 'B' WHEN score >= 60 THEN 'C' WHEN score >= 40 THEN 'D' ELSE 'F' END AS grade, score >= 60 AS exportable,
  {", ".join(f"round({x} + 1e-9, 1) AS {x}" for x in _DIMS)} FROM q3""")
def quality_reports(spark, d):
    """Quality reports as JSON, and what they say."""
    r = RP.quality_json(_quality(spark, d), _DIMS)
    s = "score double, grade string, exportable boolean, dimensions struct<" + ", ".join(f"{x}: double" for x in _DIMS) + ">"
    return r.select("entity_id", F.from_json("report", s).alias("r")).select("entity_id", "r.grade", "r.exportable", "r.dimensions.*")


@query(f"WITH {_FRESH} SELECT doc_id, level, level IN ('stale', 'critical') AS recrawl, round(fresh_score + 1e-9, 1) AS fresh_score FROM f2")
def freshness_reports(spark, d):
    r = RP.freshness_json(_fresh(spark, d), "doc_id")
    return r.select("doc_id", F.from_json("report", "age string, fresh_score double, priority double, level string, recrawl boolean").alias("r")).select("doc_id", "r.level", "r.recrawl", "r.fresh_score")


@query("""SELECT doc_id, CASE WHEN a IS NULL THEN 'unknown' WHEN a <= 0 THEN 'today' WHEN a = 1 THEN '1 day' WHEN a < 30 THEN a || ' days' WHEN a < 365 THEN (a // 30) || ' months' ELSE (a // 365) || ' years' END AS age
  FROM (SELECT doc_id, cast(floor((epoch_us(TIMESTAMPTZ '2024-11-15 00:00:00+00') - epoch_us(fetched_at)) / 86400e6) AS bigint) AS a FROM documents)""")
def age_texts(spark, d):
    return load(spark, d, "documents").select("doc_id", S.age_text(S.age_days(F.col("fetched_at"), NOW)).alias("age"))


@query("SELECT source_name, count(*) AS opened FROM (SELECT DISTINCT source_name, url FROM crawl_manifests WHERE url IS NOT NULL AND source_name IS NOT NULL) GROUP BY 1")
def crawl_states(spark, d):
    """Latest state by address and source, counted by source."""
    x = load(spark, d, "crawl_manifests").where("url IS NOT NULL AND source_name IS NOT NULL").select("url", "source_name", "manifest_id", "status_code")
    return D.last_rows(x, ["url", "source_name"], ["manifest_id"]).groupBy("source_name").agg(F.count(F.lit(1)).alias("opened"))
