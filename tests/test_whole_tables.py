"""Queries over whole tables, against brute force on rows that their SQL leaves out."""

import datetime as dt
import html
import random
import re

import numpy as np
import pytest

from lodestrata.functions import similarity as S
from lodestrata.operators import grounding as G
from lodestrata.operators import resolve as R
from lodestrata.plans import reference as Q


@pytest.fixture
def tables(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return write


def _clean_name(name):
    name = name.strip().lower()
    for p in (r"\binc\.?(?=\s|$)", r"\bltd\.?(?=\s|$)", r"\bcorp\.?(?=\s|$)", r"\bllc\.?(?=\s|$)", r"\bplc\.?(?=\s|$)", r"\bgmbh(?=\s|$)", r"\bco\.(?=\s|$)", r"\blimited(?=\s|$)", r"\bcorporation(?=\s|$)", r"\bcompany(?=\s|$)"):
        name = re.sub(p, "", name)
    return re.sub(r"\s+", " ", name).strip().strip(".,;:!?-—–").strip()


def test_name_sanitize_whole(spark, tables):
    names = ["Acme Inc.", "Éco.", "Müller GmbH", "　Ünal  Co. ", "Zürich Ltd", "Ｇｉｙ Corp", "日本inc", "—Ölfeld Company—", None]
    d = tables("review_items", list(enumerate(names)), "id long, extracted_name string")
    assert {r.id: r.clean for r in Q.name_sanitize(spark, d).collect()} == {i: _clean_name(n) for i, n in enumerate(names) if n is not None}


def test_name_normalize_whole(spark, tables):
    d = tables("startups", [(1, "Écolabs Labs"), (2, "Ünal Group"), (3, "Acme (formerly X) AI")], "record_id long, entity_name string")
    assert {r.record_id: r.canonical for r in Q.name_normalize(spark, d).collect()} == {1: "startup_ecolabs", 2: "startup_unal", 3: "startup_acme"}


def test_sanitize_text_whole(spark, tables):
    texts = ["plain  text", "a &amp; b &lt;i&gt;", "x&nbsp;y\x00z", "tab\t\tand blank", "a\n\n\n\nb&#233;", "c\x0bd\x0ce", None]
    d = tables("documents", list(enumerate(texts)), "doc_id long, text string")
    want = {i: re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", re.sub(r"[\x00-\x08\x0b-\x1f\x7f-\x9f]", "", html.unescape(t)))).strip() for i, t in enumerate(texts) if t is not None}
    assert {r.doc_id: r.clean for r in Q.sanitize_text(spark, d).collect()} == want


def test_url_day_dedup_whole(spark, tables):
    t = dt.datetime(2024, 5, 1, 12)
    rows = [(1, "HTTP://WWW.H.test/A/", t, "s"), (2, "https://h.test/a", t, "s"), (3, "https://h.test/A?utm_source=x", t, "s"), (4, "https://h.test/a", t, "r"), (5, "https://h.test/A", t + dt.timedelta(days=1), "s")]
    d = tables("crawl_manifests", rows, "manifest_id long, url string, fetched_at timestamp, source_name string")
    assert {r.manifest_id: r.is_duplicate for r in Q.url_day_dedup(spark, d).collect()} == {1: False, 2: True, 3: True, 4: False, 5: False}


def test_dates_in_text_whole(spark, tables):
    rows = [(1, "2024-02-29 10:00 +0000"), (2, "0000-01-01"), (3, "0000-01-01 or 2023-05-06"), (4, "May 5, 2024 +0000"), (5, "May 5, 0000")]
    d = tables("parsed_dates", rows, "parsed_id long, raw string")
    assert {tuple(r) for r in Q.dates_in_text(spark, d).collect()} == {(1, "2024-02-29", 1), (3, "2023-05-06", 1), (4, "2024-05-05", 1)}


def test_html_meta_whole(spark, tables):
    rows = [(1, "<html><head><title>A  b</title></head>"), (2, "<title>R&amp;D &lt;now&gt;</title><p>x"), (3, "<p>no title</p>"), (4, "<TITLE lang='en'>Upper</TITLE>"), (5, None)]
    d = tables("raw_pages", rows, "page_id long, payload string")
    assert {r.page_id: r.title for r in Q.html_meta(spark, d).collect()} == {1: "A b", 2: "R&D <now>", 3: "", 4: "Upper", 5: None}


def test_nearest_vectors_against_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vec = {i: [float(rng.randint(-2, 2)) for _ in range(4)] for i in range(300)}
    vec[7] = [0.0] * 4
    df = spark.createDataFrame([*vec.items(), (1000, None)], "id long, vec array<double>").repartition(3)
    monkeypatch.setattr(R, "SEED_BLOCK", 11)
    got = {r.pid: (r.seed_id, r.score) for r in R.nearest_vectors(df.where("id % 7 = 0").withColumnRenamed("id", "pid"), df.withColumnRenamed("id", "seed_id")).collect()}
    unit = {i: np.array(v) / (np.linalg.norm(v) or 1) for i, v in vec.items()}
    want = {}
    for p in (i for i in vec if i % 7 == 0):
        s, k = max((round(float(unit[p] @ unit[q]), 6), -q) for q in vec if q != p)
        want[p] = (-k, s)
    assert got == want


def _plain_partial_ratio(a, b):
    a, b = sorted((a, b), key=len)
    ends = range(1, len(b) + len(a))
    return max(S.ratio(a, b[max(0, e - len(a)) : min(e, len(b))]) for e in ends)


def test_partial_ratio_against_brute_force(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(S, "WINDOWS", 50)
    for n in [1, 2, 5, 31, 63, 64, 65, 127, 128, 129, 200]:
        for letters in ("ab", "abcdefgh \U0001f600é"):
            a, b = ("".join(rng.choices(letters, k=k)) for k in (n, n + rng.randint(1, 150)))
            assert S.partial_ratio(a, b) == pytest.approx(_plain_partial_ratio(a, b), abs=1e-9)
            assert S.partial_ratio("x" * n, b) == 0.0


def test_evidence_with_a_slip_is_grounded(spark):
    src = "Acme closed a round of $7.3 million. The company was founded in 2015 by two people from Ludovia."
    rows = [
        ("industry", "Ludovia", "two people fron Ludovia"),  # one letter wrong
        ("fundingTotal", "7.3M", "It is known that Acme closed a round of $7.3 million"),  # 70 to 89, and the source has the number
        ("foundedDate", "2300", "The company was founded in 2300 by two people"),  # like, but the source has no such number
        ("employeeCount", "2015", "words that are nowhere in the page"),
        ("founders", "Zed", "words that are nowhere in the page"),
        ("website", "https://acme.test", "Acme closed a round"),
    ]
    d = spark.createDataFrame([(1, f, v, e, 0.9, src) for f, v, e in rows], "record_id long, field_name string, value string, evidence string, confidence double, source string")
    got = {r.field_name: (r.status, r.grounding) for r in G.verify_field(d).collect()}
    like = {f: _plain_partial_ratio(e.lower(), src.lower()) for f, _, e in rows}
    assert 90 <= like["industry"] < 100 and 70 <= like["fundingTotal"] < 90 and like["foundedDate"] >= 90 and like["founders"] < 70
    assert got == {
        "industry": ("GROUNDED", pytest.approx(like["industry"])), "fundingTotal": ("GROUNDED", 100.0), "foundedDate": ("UNVERIFIED", pytest.approx(like["foundedDate"])),
        "employeeCount": ("UNVERIFIED", pytest.approx(like["employeeCount"])), "founders": ("UNVERIFIED", pytest.approx(like["founders"])), "website": ("UNVERIFIED", 0.0),
    }


def test_record_checks_reach_trust_and_status(spark):
    rows = [
        (1, "foundedDate", "2015-03-01", "founded in 2015", 0.91), (1, "description", "Founded in 2020, re-founded 2021, founded in 2015", "d", 0.92), (1, "fundingTotal", "$1M", "raised $1M", 0.93),
        (2, "fundingTotal", "$1M seed", "raised $1M", 0.91), (2, "description", "It raised $10B and $1M", "d", 0.92), (2, "foundedDate", None, "", 0.93),
        *[(3, f, "v", "the very same evidence", 0.9) for f in ("foundedDate", "fundingTotal", "x", "y")],
        (4, "foundedDate", "2015", "a", 0.1), (4, "fundingTotal", "$2 m", "b", 0.2), (4, "description", "founded 2015 with $2 M", "c", 0.3),
    ]
    d = spark.createDataFrame(rows, "record_id long, field_name string, value string, evidence string, confidence double").selectExpr("*", "'GROUNDED' AS status", "100.0D AS grounding")
    flags = G.record_flags(d, ["foundedDate", "fundingTotal"])
    got = sorted((r.record_id, r.check_type, r.severity) for r in flags.collect())
    assert got == [(1, "contradiction", "critical")] * 2 + [(2, "completeness", "warning"), (2, "contradiction", "warning"), (3, "duplicate_evidence", "warning"), (3, "uniformity", "warning")]
    trust = {r.record_id: (r.trust_score, r.recommendation) for r in G.trust(d, flags).collect()}
    assert {k: (float(a), b) for k, (a, b) in trust.items()} == {1: (0.5, "reject"), 2: (0.8, "review"), 3: (0.8, "review"), 4: (1.0, "accept")}
    assert {r.record_id: r.record_status for r in G.record_status(d, flags).collect()} == {1: "unverified", 2: "grounded", 3: "grounded", 4: "grounded"}


def test_trust_query_reads_record_checks(spark, tables):
    text = "The company was founded in 2015 and grew"
    d = tables("documents", [(1, "STARTUP", text)], "doc_id long, record_type string, text string")
    (t,) = Q.trust_score(spark, d).collect()
    assert (t.critical, t.recommendation) == (1, "reject")  # two of three required fields are missing
    assert Q.record_status(spark, d).first().record_status == "unverified"
