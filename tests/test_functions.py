"""Scalar functions: addresses, names, similarity, pages, chunks."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import names as N
from lodestrata.functions import pages as P
from lodestrata.functions import similarity as S
from lodestrata.functions import urls as U

NORMALIZED = [
    ("HTTPS://WWW.Host.Test/a/b/?utm_source=x&b=2&a=1#frag", "https://host.test/a/b?a=1&b=2"),
    ("http://host.test/", "http://host.test/"),
    ("http://host.test", "http://host.test"),
    ("host.test/a", "https:host.test/a"),
    ("https://host.test/x;p=1?trk=1&REF=2&q", "https://host.test/x?q"),
    ("https://host.test/a?x=http://b.test/c", "https://host.test/a?x=http://b.test/c"),
    ("", ""),
    (None, ""),
]


def _one(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", column(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_normalize_url(spark):
    assert _one(spark, [u for u, _ in NORMALIZED], U.normalize_url) == [w for _, w in NORMALIZED]
    assert _one(spark, ["https://a.test/x/", "//a.test/x"], lambda c: U.normalize_url(c, keep_scheme=False)) == ["//a.test/x", "//a.test/x"]


def test_relative_urls(spark):
    base = F.lit("https://www.base.test/dir/page.html")
    assert _one(spark, ["/x?b=1", "y", "http://o.test/z/", ""], lambda c: U.normalize_url(c, base)) == ["https://base.test/x?b=1", "https://base.test/dir/y", "http://o.test/z", ""]


def test_sanitize_url_and_parts(spark):
    got = _one(spark, [" http://www.H.test/a/?b=2&gclid=1&a=1#x", "https://h.test/", "ftp://h.test/a", None], U.sanitize_url)
    assert got == ["https://h.test/a?b=2&a=1", "https://h.test", "ftp://h.test/a", ""]
    assert _one(spark, ["https://www.Git.test/o/r/tree/x", "https://git.test/o"], U.owner_repo) == ["o/r", ""]
    assert _one(spark, ["https://WWW.A.test:80/x"], U.extract_domain) == ["a.test:80"]


def test_names(spark):
    assert _one(spark, ["Acme Inc.", " Foo  Co. Ltd ", "Limited Edition", "--Bar Corp", ""], N.sanitize_entity_name) == ["acme", "foo", "edition", "bar", ""]
    got = _one(spark, ["Mistral AI (formerly X) Labs", "Foo-Bar Technologies", "Café Group", None], N.normalize_entity_name)
    assert got == ["mistral", "foo bar", "café", None]
    assert _one(spark, ["Open AI", "???"], lambda c: N.canonical_id(c, F.lit("NEWS_SIGNAL"))) == ["news_open", "news_unknown"]
    assert _one(spark, ["Open AI", "A & B"], lambda c: N.resolved_id(c, F.lit("NEWS_SIGNAL"))) == ["news_signal_open-ai", "news_signal_a-b"]
    assert _one(spark, ["IBM", "TOOLONGX", "iBM"], N.acronym) == ["IBM", None, None]
    assert _one(spark, ["a &amp; b\x00\t c\n\n\n\nd ", None], N.sanitize_text) == ["a & b c\n\nd", None]
    assert _one(spark, ["", "a" * 9], N.estimate_tokens) == [1, 2]
    assert _one(spark, ["raw/s/2024/01/02/abc/payload.html", "x/y"], N.hash_of_key) == ["abc", ""]


def test_model_json(spark):
    got = _one(spark, ['```json\n{"a": 1}\n```', 'Sure: {"a": 2} done', "no", None], lambda c: N.parse_model_json(c, "a int").getField("a"))
    assert got == [1, 2, None, None]


def _lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


def test_ratios():
    rng = random.Random(7)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(9))) for _ in range(2))
        assert S.lcs_length(a, b) == _lcs(a, b)
        short, long = sorted((a, b), key=len)
        if short:
            n = len(short)
            want = max(S.ratio(short, long[max(0, e - n) : min(e, len(long))]) for e in range(1, len(long) + n))
            assert S.partial_ratio(a, b) == pytest.approx(want)
    assert S.token_sort_ratio("b a", "a b") == 100 and S.ratio("", "") == 100 and S.partial_ratio("", "x") == 0
    assert S.ratio("abcd", "abxd") == pytest.approx(75.0)


def test_pages(spark):
    page = '<html><head><title> A  &amp; B </title><meta property="og:title" content="T"><script>no()</script></head><body><nav>menu</nav><p style="display: none">hid</p><p>One <b>two</b></p><br><a href="/x">go</a></body></html>'
    df = spark.createDataFrame([(1, page, "clash"), (2, None, ""), (3, "", "")], "id int, html string, title string")
    got = {r.id: r for r in P.page_parts(df, "id", "html").collect()}
    assert (got[1].title, got[1].links, got[1].main_text) == ("A & B", ["/x"], "One\ntwo\ngo") and got[1].metas[0].content == "T"
    assert got[2].title is None and got[3].main_text == ""


def _chunks(text, most, overlap):
    tok = lambda s: max(1, len(s) // 4)
    if not text:
        return []
    if tok(text) <= most:
        return [(text, tok(text))]
    import re

    out, cur, n = [], "", 0
    for p in re.split(r"\n\n+", text):
        if n + tok(p) > most and cur:
            out.append((cur.strip(" "), n))
            cur = (cur[-overlap * 4 :] if overlap else "") + "\n\n" + p
            n = tok(cur)
        else:
            cur, n = (cur + "\n\n" + p if cur else p), n + tok(p)
    return out + [(cur.strip(" "), n)] if cur.strip() else out


def test_chunks(spark):
    rng = random.Random(2)
    texts = ["", None, "short"] + ["\n\n".join("w" * rng.randrange(1, 200) for _ in range(rng.randrange(1, 12))) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for overlap in (0, 5):
        got = {}
        for r in sorted(P.chunk_texts(df, "id", "text", 60, overlap).collect(), key=lambda r: (r.id, r.chunk_index)):
            got.setdefault(r.id, []).append((r.text, r.token_count))
        assert got == {i: c for i, t in enumerate(texts) if (c := _chunks(t, 60, overlap))}


def test_dates(spark):
    import datetime as dt

    from lodestrata.functions import dates as DT

    texts = ["on 2024-02-30 or 2024-02-29", "May 5, 2024 and 6 May 2024", "none", None]
    assert _one(spark, texts, DT.dates_in) == [[dt.date(2024, 2, 29)], [dt.date(2024, 5, 5), dt.date(2024, 5, 6)], [], None]
    assert _one(spark, texts, lambda c: DT.date_score(F.lit("2024-05-07").cast("date"), c)) == [None, 0.0, None, None]
    assert _one(spark, ["2024-01-01 00:00:00", "2024-01-02 12:00:00"], lambda c: DT.within_hours(c.cast("timestamp"), "2024-01-03 00:00:00", 24)) == [False, True]


def test_command_line(capsys):
    from lodestrata.__main__ import main

    assert main(["list"]) == 0 and "vote_fields" in capsys.readouterr().out


def test_schemas_parse(spark):
    from pyspark.sql.types import StructType

    from lodestrata import schemas

    for k, v in vars(schemas).items():
        if k.isupper() and not v.startswith("struct<"):
            assert isinstance(spark.createDataFrame([], v).schema, StructType)
