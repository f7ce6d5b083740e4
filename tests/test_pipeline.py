"""Verification, messages, resolution, export tabs and reports against brute force and cases worked out by hand."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import dates as DT
from lodestrata.functions.similarity import token_sort_ratio
from lodestrata.operators import export as X
from lodestrata.operators import extraction as E
from lodestrata.operators import messages as M
from lodestrata.operators import reports as RP
from lodestrata.operators import resolve as R
from lodestrata.operators import verify as Y

T0 = dt.datetime(2024, 5, 1, tzinfo=dt.UTC)


def test_verifiers(spark):
    src = "Acme Robotics raised $6.6 billion on May 3, 2024. See https://acme.example/about and acme.test/x."
    rows = [
        (1, "description", "Acme Robotics", "Acme Robotics raised", src, "GROUNDED"), (2, "description", "Acme Robotcs", "", src, "GROUNDED"), (3, "description", "Zeta", "quite another evidence text", src, "UNVERIFIED"),
        (4, "description", "Zeta", "Acme Robotics raised", src, "UNVERIFIED"), (5, "description", " ", "x", src, "MISSING"), (6, "description", None, None, src, "MISSING"),
        (7, "fundingTotal", "6.6B", "", src, "GROUNDED"), (8, "fundingTotal", "$6.63 billion", None, src, "GROUNDED"), (9, "fundingTotal", "7B", "raised 7 billion", src, "GROUNDED"), (10, "fundingTotal", "9B", "", src, "UNVERIFIED"), (11, "fundingTotal", "much", "", src, "MISSING"),
        (12, "publishedDate", "2024-05-03", "", src, "GROUNDED"), (13, "publishedDate", "2024-05-04", None, src, "GROUNDED"), (14, "publishedDate", "2024-05-06", "", src, "UNVERIFIED"), (15, "publishedDate", "soon", "", src, "MISSING"),
        (16, "website", "https://acme.example/about", "", src, "GROUNDED"), (17, "website", "https://acme.test/x", "", src, "GROUNDED"), (18, "website", "https://other.example", "", src, "UNVERIFIED"), (19, "website", "", "", src, "MISSING"),
    ]
    d = spark.createDataFrame([r[:5] for r in rows], "record_id long, field_name string, value string, evidence string, source string")
    got = {r.record_id: (r.status, r.score) for r in Y.verify_fields(d).collect()}
    assert {k: v[0] for k, v in got.items()} == {r[0]: r[5] for r in rows}
    assert got[7][1] == 1.0 and abs(got[8][1] - (1 - 0.03 / 6.6)) < 1e-6 and got[12][1] == 1.0 and got[13][1] == 0.0 and got[16][1] == 1.0 and got[17][1] == 0.95
    assert Y.verify_fields(d.limit(0)).count() == 0
    v = spark.createDataFrame([(1, "GROUNDED"), (1, "CONFLICTING"), (2, "GROUNDED"), (3, "GROUNDED"), (3, "MISSING"), (4, "MISSING")], "record_id long, status string")
    assert {r.record_id: r.verdict for r in Y.record_verdict(v).collect()} == {1: "rejected", 2: "grounded", 3: "partial", 4: "unverified"}


def test_fuzzy_loses_no_pair(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeäß") for _ in range(rng.randrange(1, 7)))
    names = [" ".join(word() for _ in range(rng.randrange(1, 4))) for _ in range(120)]
    qs = [rng.choice(names)[::1] for _ in range(60)] + [" ".join(word() for _ in range(2)) for _ in range(60)]
    qs = [q if rng.random() < 0.4 else q[: (i := rng.randrange(len(q) + 1))] + rng.choice("xyz ") + q[i + rng.randrange(2) :] for q in qs]
    kinds = ["A", "B"]
    n = [(f"s{i}", x, kinds[i % 2]) for i, x in enumerate(names)]
    q = [(i, x, kinds[(i // 2) % 2]) for i, x in enumerate(qs)]
    got = {(r.qid, r.canonical_id): r.score for r in R.fuzzy_topk(spark.createDataFrame(q, "qid long, qname string, record_type string"), spark.createDataFrame(n, "canonical_id string, name string, record_type string"), k=1000).collect()}
    want = {(i, c): round(s, 6) for i, x, t in q for c, y, u in n if t == u and x.split() and y.split() and (s := token_sort_ratio(x.lower(), y.lower())) >= 85}
    assert got == want and want


def test_cascade_by_type_and_embedding(spark):
    seeds = spark.createDataFrame([("s1", "Glowforge", "STARTUP", [], 0), ("p1", "Clowforges", "PAPER", [], 1), ("s2", "Northern Lights", "STARTUP", None, 2)], "canonical_id string, name string, record_type string, aliases array<string>, pos long")
    q = spark.createDataFrame([(1, "clowforge", "STARTUP"), (2, "clowforge", "PAPER"), (3, "lights northern xx yy", "STARTUP"), (4, "", "JOB"), (5, "qqq", "PAPER"), (6, "qqq", None)], "qid long, qname string, record_type string")
    got = {r.qid: r for r in R.resolve_cascade(q, seeds, embed=R.name_vectors).collect()}
    assert {k: (r.canonical_id, r.method) for k, r in got.items() if k in (1, 2, 4, 5)} == {1: ("s1", "fuzzy"), 2: ("p1", "fuzzy"), 4: ("job_unknown", "unresolved"), 5: ("paper_qqq", "unresolved")}
    assert got[3].method in ("embedding", "unresolved") and (got[3].canonical_id == "s2" or got[3].review_of == "s2") and got[3].confidence >= 0.75
    e = spark.createDataFrame([("Glowforge", "nobody", "STARTUP"), (None, "Northern Lights", "STARTUP")], "source string, target string, record_type string")
    assert {(r.source_id, r.target_id) for r in R.edge_endpoints(e, seeds).collect()} == {("s1", "startup_nobody"), (None, "s2")}


@pytest.mark.parametrize("seed", [1, 2])
def test_throttle_is_a_token_bucket(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice("ab"), T0 + dt.timedelta(seconds=rng.randrange(40_000) / (1 if rng.random() < 0.5 else 100))) for i in range(400)] + [(900, None, T0), (901, "a", None)]
    rates = {"a": 0.01, "b": 3.0}
    df = spark.createDataFrame(rows, "id long, k string, at timestamp")
    got = {r.id: r.wait for r in M.throttle(df, "k", "at", "id", spark.createDataFrame(list(rates.items()), "k string, rate double")).collect()}
    assert got.pop(900) == 0 and got.pop(901) == 0
    for k, rate in rates.items():
        cap = max(rate, 1.0)
        tokens, last = cap, None
        for i, _, t in sorted((r for r in rows if r[1] == k and r[2]), key=lambda r: (r[2], r[0])):
            t = t.timestamp()
            now = t if last is None else max(t, last)
            tokens = tokens if last is None else min(cap, tokens + (now - last) * rate)
            start = now + max(0.0, (1 - tokens) / rate)
            tokens = min(cap, tokens + (start - now) * rate) - 1
            last = start
            assert abs(got[i] - (start - t)) < 1e-3


def test_messages(spark):
    x = spark.createDataFrame([(1, 'a "b"', None, T0), (2, None, 3, None)], "id long, s string, n int, at timestamp")
    schema = "id long, s string, n int, at timestamp"
    assert M.decode(M.encode(x), schema).collect() == x.collect()
    assert M.decode(spark.createDataFrame([(bytearray(b'{"id": 5}'),), (bytearray(b"no json"),)], "data binary"), schema).collect()[0].id == 5
    p = spark.createDataFrame([(1, T0, 0, 5), (2, T0, 4, 5), (3, T0 + dt.timedelta(minutes=9), 0, 5), (4, None, 0, 5), (5, T0, None, None)], "id long, received_at timestamp, attempt int, max_attempts int")
    got = {r.id: (r.route, r.next_attempt) for r in M.claim_stale(p, F.lit("2024-05-01 00:10:00").cast("timestamp")).collect()}
    assert got == {1: ("retry", 1), 2: ("dead_letter", 5), 3: ("wait", 0), 4: ("wait", 0), 5: ("retry", 1)}
    pr = spark.createDataFrame([("gem", 0, "OPEN"), ("groq", 1, "CLOSED"), ("loc", 2, "HALF_OPEN")], "provider string, pos int, state string")
    r = spark.createDataFrame([(1, "any"), (2, "saving")], "id long, mode string")
    assert {x.id: x.provider for x in M.choose_provider(r, pr).collect()} == {1: "groq", 2: None}
    assert {x.id: x.provider for x in M.choose_provider(r, pr.where("pos > 0")).collect()} == {1: "groq", 2: "groq"}
    b = M.batches(spark.range(1234).select(F.lit("g").alias("g"), "id"), "g", ["id"], 100).groupBy("batch").count().collect()
    assert sorted(x["count"] for x in b) == [34] + [100] * 12 and {x.batch for x in b} == set(range(13))


def test_export_tabs(spark):
    d = spark.createDataFrame([("c1", None, "grounded", "u", ["a", "", None, "b"], 3, None)], "canonical_id string, entity_name string, verification_status string, source_url string, founders array<string>, n int, none string")
    r = X.tab_rows(d, "STARTUP", {"founders": F.col("founders"), "employeeCount": F.col("n"), "website": F.col("none")}).collect()[0].asDict()
    assert list(r) == [*X.COMMON, *X.COLUMNS["STARTUP"].values()] and r["Founders"] == "a; b" and r["Employee Count"] == "3" and r["Website"] == "" and r["Entity Name"] == "" and r["Record Type"] == "STARTUP"
    for kind, tab in X.TABS.items():
        x = X.tab_rows(d.limit(0), kind, {})
        assert len(x.columns) == 5 + len(X.COLUMNS[kind]) and x.count() == 0 and tab


def test_page_metadata(spark):
    metas = [("citation_title", "T"), ("citation_author", "A B; C D, E"), ("citation_keywords", "x, y"), ("description", "d" * 600), ("citation_date", "2024/01/02")]
    p = spark.createDataFrame([(1, "page", metas, "https://arxiv.org/abs/2401.01234"), (2, "only title", [], "https://x.test/2024/03/04/a"), (3, "", None, None)], "page_id long, title string, metas array<struct<name:string,content:string>>, url string")
    got = {(r.page_id, r.field_name, r.idx): (r.value, r.confidence) for r in E.paper_metadata(p, "page_id", "url").collect()}
    assert got[1, "title", None] == ("T", 0.85) and [got[1, "authors", i][0] for i in range(3)] == ["A B", "C D", "E"] and got[1, "arxivId", None][0] == "2401.01234" and len(got[1, "abstract", None][0]) == 500
    assert got[1, "categories", 1][0] == "y" and (2, "title", None) in got and not any(k[0] == 3 for k in got)
    got = {(r.page_id, r.field_name): (r.value, r.confidence) for r in E.page_fields(p, "page_id", "url").collect()}
    assert got[2, "publishedDate"] == ("2024-03-04", 0.70) and got[2, "title"][0] == "only title"


def test_answers_and_dates(spark):
    rows = ['{"a": 1}', '```json\n{"a": 1}\n```', 'text {"a": 1} more', "[1, 2]", "so: [1, 2].", "nothing", "", "{broken", None]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i long, x string").select("i", F.to_json(E.read_answer(F.col("x"))).alias("j"))
    got = {r.i: json.loads(r.j) for r in d.collect()}
    assert [got[i] for i in range(9)] == [{"a": 1}] * 3 + [{"items": [1, 2]}] * 2 + [{}] * 4
    cases = {
        "2024-02-03T04:05:06Z": ("strict", "2024-02-03 04:05:06"), "Mon, 5 Feb 2024 04:05:06 GMT": ("strict", "2024-02-05 04:05:06"), "2024-02-03": ("strict", "2024-02-03 00:00:00"), "2 months ago": ("heuristic", "2024-03-02 00:00:00"),
        "1 year ago": ("heuristic", "2023-05-02 00:00:00"), "3 hours ago": ("heuristic", "2024-04-30 21:00:00"), "Yesterday": ("heuristic", "2024-04-30 00:00:00"), "just now": ("heuristic", "2024-05-01 00:00:00"),
        "published on 2024-01-05, late": ("heuristic", "2024-01-05 00:00:00"), "whenever": None, "": None,
    }
    d = spark.createDataFrame([(k,) for k in cases] + [(None,)], "x string").select("x", DT.layered_date(F.col("x"), F.lit("2024-05-01 00:00:00").cast("timestamp")).alias("r"))
    assert {r.x: r.r and (r.r.confidence, str(r.r.value)) for r in d.select("x", "r").collect()} == {**cases, None: None}


def test_prompts(spark):
    d = spark.createDataFrame([("PAPER", "x {content} y"), ("OTHER", None), (None, "z")], "k string, t string").select(E.prompts(F.col("k"), F.col("t")).alias("p"))
    got = [r.p for r in d.collect()]
    assert got[0].endswith("\n\nx {content} y") and "paper" in got[0] and got[1].endswith("\n\n") and "company" in got[1] and got[2].endswith("\n\nz")


def test_observed(spark, tmp_path):
    x, o = RP.observed(spark.range(10), "ten", rows=F.count(F.lit(1)), top=F.max("id"))
    x.write.parquet(f"file://{tmp_path}/x")
    assert o.get == {"rows": 10, "top": 9}
