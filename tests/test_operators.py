"""Voting, scores, grounding, resolution, export, upserts, sources and streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import export as X
from lodestrata.operators import grounding as G
from lodestrata.operators import resolve as R
from lodestrata.operators import scoring as S
from lodestrata.operators import upserts as D
from lodestrata.operators import voting as V
from lodestrata.sources import listings, stores
from lodestrata.streaming import flows

NOW = "2024-06-01 00:00:00"
T = dt.datetime(2024, 6, 1)


def _assert(*rows):
    return [(i, "e", f, p, v, f"u{i}", s, g, t, T - dt.timedelta(days=age) if age is not None else None) for i, (f, p, v, s, g, t, age) in enumerate(rows)]


SCHEMA = "assertion_id long, entity_id string, field_name string, pos int, value string, source_url string, source_name string, grounding_score double, trust_score double, fetched_at timestamp"


def test_voting(spark):
    rows = _assert(
        ("single", 0, "x", "crunchbase", 0.9, 0.9, 0),
        ("unanimous", 0, "A  b", "github", 1.0, 1.0, 0), ("unanimous", 1, "a B ", "github", 1.0, 1.0, 0),
        ("majority", 0, "x", "s", 0.5, 0.5, 0), ("majority", 1, "x", "s", 0.5, 0.5, 0), ("majority", 2, "y", "s", 0.1, 0.1, 0),
        ("quality", 0, "x", "s", 0.1, 0.1, 0), ("quality", 1, "y", "arxiv", 1.0, 1.0, 0),
        ("zero", 1, "b", "s", 0.0, 0.0, None), ("zero", 0, "a", "s", 0.0, 0.0, None),
        ("null", 0, None, "s", 1.0, 1.0, 0),
    )
    scored = V.score_assertions(spark.createDataFrame(rows, SCHEMA), NOW)
    got = {r.field_name: r for r in V.vote_fields(scored).collect()}
    assert (got["single"].winner, got["single"].confidence, got["single"].method) == ("x", 0.7, "single_source")
    assert (got["unanimous"].winner, got["unanimous"].method, got["unanimous"].contested) == ("A  b", "unanimous", False)
    assert got["unanimous"].confidence == pytest.approx(0.5 + 0.5 * 0.92, abs=1e-4)
    assert (got["majority"].method, got["majority"].consensus) == ("majority_vote", 0.667)
    assert (got["quality"].winner, got["quality"].method) == ("y", "quality_winner")
    assert (got["zero"].winner, got["zero"].confidence) == ("a", 0.0) and "null" not in got
    rep = V.vote_report(V.vote_fields(scored)).first()
    assert (rep.fields, rep.contested_fields, rep.unanimous_fields) == (5, 3, 2)


def test_recency(spark):
    df = spark.createDataFrame([(T,), (T + dt.timedelta(days=9),), (T - dt.timedelta(days=30),), (T - dt.timedelta(days=3000),), (None,)], "t timestamp")
    assert [r[0] for r in df.select(V.recency(F.col("t"), NOW)).collect()] == [1.0, 1.0, 0.5, 0.1, 0.1]


def test_quality_and_freshness(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,), (10**6,)], "n long")
    assert [r[0] for r in df.select(S.source_diversity(F.col("n"))).collect()] == [0.0, 40.0, 70.0, 85.0, 100.0, 100.0]
    q = spark.createDataFrame([(100.0,) * 6, (10.0,) * 6], "source_diversity double, grounding double, consensus double, trust double, completeness double, freshness double")
    a, b = S.quality(q).collect()
    assert (a.grade, a.exportable, a.recommendations) == ("A", True, "excellent") and (b.grade, b.needs_recrawl) == ("F", True)
    f = spark.createDataFrame([("JOB", T - dt.timedelta(days=k)) for k in (0, 5, 7, 14)] + [("NEWS_SIGNAL", None), ("OTHER", T + dt.timedelta(days=1))], "record_type string, fetched_at timestamp")
    got = [(r.level, round(r.priority, 3)) for r in S.assess_freshness(f, NOW).collect()]
    assert got == [("fresh", 0.0), ("aging", 0.714), ("stale", 1.0), ("critical", 1.0), ("critical", 1.0), ("fresh", 0.0)]
    c = spark.range(1).select(S.entity_confidence(F.lit(1.0), F.lit(1.0), F.lit(5), F.lit(True), F.lit(3), F.lit(False)), S.edge_confidence(F.lit(0.5), F.lit(1.0), F.lit(1.0), F.lit(False)), S.age_text(F.lit(40.0))).first()
    assert tuple(c) == (1.0, 0.7, "1 months")


SRC = "Acme raised $7.3 billion. The company was founded in 2015 by two people and employs 1,700 staff. See https://acme.test/x."


def _fields(spark, rows):
    return spark.createDataFrame([(1, "STARTUP", f, v, e, c, SRC) for f, v, e, c in rows], "record_id long, record_type string, field_name string, value string, evidence string, confidence double, source string")


def test_verify_and_flags(spark):
    d = _fields(spark, [
        ("fundingTotal", "7.3B", "raised $7.3 billion", 0.9), ("employeeCount", "1700", "employs 1,700 staff", 0.9), ("website", "https://acme.test/x/", "x", 0.5), ("foundedDate", "2031", "founded in 2031 surely yes", 0.9),
        ("description", None, None, 0.1), ("industry", "AI", "", 0.2), ("founders", "Zed Quux", "words never seen anywhere here", 0.3), ("headquarters", "Silicon Valley", "According to the website we know", 0.95),
        ("citations", "9999999", "two people and employs", 0.2),
    ])
    v = G.verify_field(d)
    status = {r.field_name: r.status for r in v.collect()}
    assert status == {"fundingTotal": "GROUNDED", "employeeCount": "GROUNDED", "website": "GROUNDED", "foundedDate": "UNVERIFIED", "description": "MISSING", "industry": "UNVERIFIED", "founders": "UNVERIFIED", "headquarters": "UNVERIFIED", "citations": "UNVERIFIED"}
    flags = {(r.field_name, r.check_type, r.severity) for r in G.field_flags(v, 2024).collect()}
    assert {("foundedDate", "suspicious", "critical"), ("founders", "fabrication", "critical"), ("headquarters", "suspicious", "warning"), ("citations", "outlier", "critical"), ("industry", "fabrication", "warning"), ("founders", "attribution", "warning")} <= flags
    assert {f for f in flags if f[0] in ("fundingTotal", "employeeCount", "description")} == {("fundingTotal", "attribution", "warning"), ("employeeCount", "attribution", "warning")}
    t = G.trust(v, G.field_flags(v, 2024)).first()
    assert (t.fields_checked, t.recommendation, t.trustworthy, t.trust_score) == (8, "reject", False, 0.0)
    r = G.record_status(v).first()
    assert (r.total, r.grounded, r.record_status) == (9, 3, "unverified")


def test_numbers(spark):
    df = spark.createDataFrame([("$6.6B raised",), ("6.6 billion",), ("1,700",), ("2015 by",), ("80 bn and 3k",), ("none",)], "t string")
    assert [r[0] for r in df.select(G.all_numbers(F.col("t"))).collect()] == [[6.6e9], [6.6e9], [1700.0], [2015.0], [80e9, 3000.0], []]
    assert [r[0] for r in spark.range(1).select(G.near_number(F.lit(101.0), F.array(F.lit(0.0), F.lit(100.0))), ).collect()] == [True]


def test_record_checks(spark):
    rows = [(1, f"f{i}", "v", "the very same evidence", 0.9) for i in range(3)] + [(2, f"f{i}", "v", "short", 0.5 + i / 10) for i in range(4)] + [(3, f"f{i}", "v", "x", 0.8) for i in range(4)]
    d = spark.createDataFrame(rows, "record_id long, field_name string, value string, evidence string, confidence double")
    assert [(r.record_id, r.fields) for r in G.duplicate_evidence(d).collect()] == [(1, 3)]
    assert [(r.record_id, r.fields) for r in G.uniform_confidence(d).collect()] == [(3, 4)]
    assert {(r.record_id, r.missing, r.severity) for r in G.missing_required(d, ["f0", "f3", "zz"]).collect()} == {(1, 2, "critical"), (2, 1, "warning"), (3, 1, "warning")}


def test_resolution(spark):
    seeds = spark.createDataFrame([("s1", "Acme Inc", "STARTUP", ["ACME Corp"], 0), ("s2", "Beta Works", "STARTUP", None, 1), ("p1", "acme corp", "PRODUCT", [], 2)], "canonical_id string, name string, record_type string, aliases array<string>, pos long")
    q = spark.createDataFrame([(1, "acme inc", "STARTUP"), (2, "ACME CORP", "STARTUP"), (3, "Acme", "STARTUP"), (4, "works betaa", "STARTUP"), (5, "Nothing Alike", "JOB"), (6, " ", "JOB"), (7, None, "JOB")], "qid long, qname string, record_type string")
    got = {r.qid: (r.canonical_id, r.method) for r in R.resolve_cascade(q, seeds).collect()}
    assert got == {1: ("s1", "exact"), 2: ("p1", "exact"), 3: ("p1", "normalized"), 4: ("s2", "fuzzy"), 5: ("job_nothing-alike", "unresolved"), 6: ("job_unknown", "unresolved"), 7: ("job_unknown", "unresolved")}
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.0, 0.0])], "pid long, vec array<double>")
    s = spark.createDataFrame([(9, [1.0, 0.0]), (8, [1.0, 0.0])], "seed_id long, vec array<double>")
    assert {(r.pid, r.seed_id, r.band) for r in R.vector_match(v, s).collect()} == {(1, 8, "accept"), (2, 8, "review"), (3, 8, "none")}


def test_export(spark):
    df = spark.createDataFrame([(True, "grounded", "t", "c", "exact"), (False, "rejected", "", None, "unresolved")], "ok boolean, status string, title string, company string, method string")
    got = [r[0] for r in df.select(X.export_errors(F.col("ok"), F.col("status"), [F.col("title"), F.col("company")], F.col("method"))).collect()]
    assert got == [[], ["schema", "status", "required", "resolution"]]
    assert spark.range(1).select(X.list_cell(F.array(F.lit("a"), F.lit(""), F.lit("b"))), X.cell(F.lit(None)), X.cell(F.lit(None), True), X.valid_edge(F.lit("CITES"), F.lit("PAPER"), F.lit("JOB")), X.valid_edge(F.lit("CITES"), F.lit("PAPER"), F.lit("JOB"), True)).first() == ("a; b", "", "None", True, False)


def test_upserts(spark):
    df = spark.createDataFrame([(1, "k", "first", "old"), (2, "k", "later", "new"), (3, "z", None, "x")], "seq long, key string, name string, status string")
    got = {r.key: (r.name, r.status, r.source_count) for r in D.upsert_fold(df, "key", ["seq"], ["name"], ["status"]).collect()}
    assert got == {"k": ("first", "new", 2), "z": (None, "x", 1)}
    assert {(r.key, r.seq) for r in D.first_rows(df, ["key"], ["seq"]).collect()} == {("k", 1), ("z", 3)}
    assert {(r.key, r.seq) for r in D.last_rows(df, ["key"], ["seq"]).collect()} == {("k", 2), ("z", 3)}
    assert D.unseen(df, df.where("seq = 1"), ["key"]).count() == 1


def test_listings(spark, tmp_path):
    rss = "<rss><channel><item><link>https://a.test/1</link></item><item><link>https://a.test/1</link></item><item><guid>https://a.test/2</guid></item><item><link>ftp://x</link></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><link rel="alternate" href="https://b.test/1"/></entry><entry><link href="https://b.test/2"/></entry></feed>'
    df = spark.createDataFrame([(1, rss), (2, atom), (3, "no xml"), (4, None)], "id int, xml string")
    got = {(r.id, r.url) for r in listings.feed_links(df, "id", "xml").collect()}
    assert got == {(1, "https://a.test/1"), (1, "https://a.test/2"), (2, "https://b.test/1"), (2, "https://b.test/2")}
    js = spark.createDataFrame([(1, '{"jobs": [{"url": "u1"}, {"x": 1}]}'), (2, "bad")], "id int, p string")
    assert [tuple(r) for r in listings.json_urls(js, "id", "p").collect()] == [(1, "u1")]
    for off in (0, 100):
        (tmp_path / f"page-{off}.json").write_text(json.dumps([{"n": off}, {"n": off + 1}]))
    pages = listings.paged_listing(spark, f"file://{tmp_path}")
    assert {(r.offset, r.pos) for r in pages.collect()} == {(0, 0), (0, 1), (100, 0), (100, 1)}
    found = listings.discover(spark.createDataFrame([("https://A.test/x/", "s"), ("https://a.test/x", "s"), ("", "s"), ("https://a.test/y", "s")], "url string, source_name string"), spark.createDataFrame([("https://a.test/y", "s")], "url string, source_name string"))
    assert [r.url for r in found.collect()] == ["https://a.test/x"]


def test_stores(spark, tmp_path):
    raw = spark.createDataFrame([("s", T, "h1", "text/html", "p1", {"a": "b"}), ("t", T, "h2", "application/json", "p2", None)], "source_name string, fetched_at timestamp, content_hash string, content_type string, payload string, headers map<string,string>")
    stores.write_raw(raw, str(tmp_path / "raw"))
    assert [(r.key, r.payload) for r in stores.read_raw(spark, str(tmp_path / "raw"), "t", "2024-06-01").collect()] == [("raw/t/2024/06/01/h2/payload.json", "p2")]
    (tmp_path / "seeds.json").write_text('[{"canonical_id": "a", "name": "A"}, {"canonical_id": "b", "name": "B", "record_type": "PAPER", "aliases": ["x"]}]')
    assert [(r.canonical_id, r.record_type, r.aliases) for r in stores.read_seeds(spark, str(tmp_path / "seeds.json")).collect()] == [("a", "STARTUP", []), ("b", "PAPER", ["x"])]
    good, dead = stores.split_failed(raw.withColumn("err", F.when(F.col("source_name") == "t", "bad")), "crawl", "err")
    assert good.count() == 1 and json.loads(dead.first().original_data)["payload"] == "p2"


def test_breaker():
    calls = [(0, False), (1, False), (2, True), (100, False), (103, True), (104, True)]
    got = list(flows.breaker_steps(calls, failures=2, open_us=50))
    assert got == [(0, "CLOSED", True), (1, "CLOSED", True), (2, "OPEN", False), (100, "HALF_OPEN", True), (103, "OPEN", False), (104, "OPEN", False)]


def test_streams(spark, tmp_path):
    rows = [(i, f"{i % 7:032x}", f"u{i}", T + dt.timedelta(minutes=i), i % 3, 2, "s", i % 5 != 0) for i in range(60)]
    schema = "entry_id long, message_id string, url string, received_at timestamp, attempt int, max_attempts int, source_name string, ok boolean"
    for k in range(3):
        spark.createDataFrame(rows[k * 20 : k * 20 + 20], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    s = lambda: flows.read_stream(spark, str(tmp_path / "in"), 1)
    assert flows.drain(flows.dedup_messages(s()), "t-dedup").count() == 7
    assert flows.drain(flows.dead_letters(s()).where("error IS NOT NULL"), "t-dead").count() == 20
    assert {r.n for r in flows.drain(flows.window_counts(s(), "received_at", "source_name"), "t-win", "complete").collect()} == {60}
    assert flows.drain(flows.circuit_breaker(s(), "source_name", "received_at", "ok", 2, 1_000_000), "t-brk").count() == 60
    flows.upsert_batches(s().select("message_id", "entry_id", "url"), str(tmp_path / "table"), "message_id", ["entry_id"], str(tmp_path / "cp")).awaitTermination()
    table, three = f"file://{tmp_path}/table", "message_id string, entry_id long, url string"
    assert flows.read_upserts(spark, f"file://{tmp_path}/none", three, "message_id", ["entry_id"]).count() == 0
    for _ in range(2):
        assert {r.entry_id for r in flows.read_upserts(spark, table, three, "message_id", ["entry_id"]).collect()} == set(range(53, 60))
        flows.compact_upserts(spark, table, three, "message_id", ["entry_id"])
    # a query with a new checkpoint adds to the table, and what is compacted stays
    spark.createDataFrame([(rows[53][0] + 1000, *rows[53][1:])], schema).write.parquet(str(tmp_path / "more"))
    flows.upsert_batches(flows.read_stream(spark, str(tmp_path / "more")).select("message_id", "entry_id", "url"), table, "message_id", ["entry_id"], str(tmp_path / "cp2")).awaitTermination()
    assert {r.entry_id for r in flows.read_upserts(spark, table, three, "message_id", ["entry_id"]).collect()} == {1053, *range(54, 60)}


def test_extraction(spark):
    from lodestrata.operators import extraction as E

    ans = '{"name": {"value": "Acme", "evidence": "Acme said", "confidence": 0.9}, "tags": ["a", {"value": "b"}], "n": 3, "none": null, "relationships": [{"source": "A", "target": "B", "type": "CITES", "confidence": 7}, {"source": "A"}]}'
    df = spark.createDataFrame([(1, ans), (2, "no json"), (3, "[1]"), (4, None)], "id long, answer string")
    got = {(r.field_name, r.idx): (r.value, r.evidence, r.confidence) for r in E.evidenced_fields(df, "id", "answer").collect()}
    assert got == {("name", None): ("Acme", "Acme said", 0.9), ("tags", 0): ("a", None, 0.0), ("tags", 1): ("b", None, 0.0), ("n", None): ("3", None, 0.0), ("none", None): (None, None, 0.0)}
    assert [tuple(r) for r in E.relationships(df, "id", "answer").collect()] == [(1, "A", "B", "CITES", "", 1.0)]
    x = spark.createDataFrame([("429 Too Many Requests",), ("maximum context length",), ("boom",)], "m string")
    assert [r[0] for r in x.select(E.error_class(F.col("m"))).collect()] == ["rate_limit", "context_length", "generic"]
    m = spark.createDataFrame([(1, "Page", [("og:title", " "), ("twitter:title", "T"), ("description", "D" * 600)], "https://a.test/2024/05/06/x")], "id int, title string, metas array<struct<name:string,content:string>>, url string")
    r = E.page_metadata(m, "id", "url").first()
    assert (r.title, len(r.description), r.author, r.date) == ("T", 500, None, "2024-05-06")
    c = spark.createDataFrame([(1, "f", 1, "late"), (1, "f", 0, "first"), (1, "g", 0, None)], "record_id long, field_name string, chunk_index int, value string")
    assert [tuple(r) for r in E.merge_chunks(c).collect()] == [(1, "f", "first", 0)]


def test_crawling(spark):
    from lodestrata.operators import crawling as C

    rules = spark.createDataFrame([("a.test", "/", True), ("a.test", "/private", False), ("a.test", "/private/ok", True)], "host string, path string, allow boolean")
    urls = spark.createDataFrame([("https://www.a.test/x",), ("https://a.test/private/1",), ("https://a.test/private/ok/2",), ("https://b.test/private",)], "url string")
    assert {r.url: r.allowed for r in C.robots_allowed(urls, rules).collect()} == {"https://www.a.test/x": True, "https://a.test/private/1": False, "https://a.test/private/ok/2": True, "https://b.test/private": True}
    assert C.token_bucket([0.0, 0.0, 0.0, 10.0], 1.0) == [0.0, 1.0, 1.0, 0.0]
    p = spark.createDataFrame([("d", f"p{i}", s, f) for i, (s, f) in enumerate([(9, 1), (0, 0), (1, 9), (5, 5), (8, 2)])], "domain string, proxy string, success long, failure long")
    assert [r.proxy for r in C.best_proxies(p).orderBy("rank").collect()] == ["p1", "p0", "p4"]
