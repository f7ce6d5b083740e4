"""Boilerplate, leakage, packing and personal information."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lodestrata.llm import boilerplate
from lodestrata.llm.boilerplate import common, main_content
from lodestrata.llm.leakage import find_leaks, remove_leaks, words
from lodestrata.llm.packing import load_tokenizer, pack, plan, token_counts
from lodestrata.llm.pii import em, find_pii, majority, mask_pii, train


def _lcs(a, b):
    m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
    return m[-1][-1]


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        c = common(a, b)
        assert len(c) == _lcs(a, b) and all(a[i] == b[j] for i, j in c)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(c, c[1:], strict=False))


NAV = ["Home", "Jobs", "Search", "Subscribe"]


def _site(n=14):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    sentence = lambda: f"The {word()} of {word()} gained {rng.randrange(999)} more {word()} in {word()}."
    pages, want = [], set()
    for p in range(n):
        rows = [("<html>", 0), (f"<head><title>{word()} - site</title></head>", 0), ("<body>", 0), ("<nav>", 0)]
        rows += [(f'<a href="/{x}">{x}</a>', 0) for x in NAV] + [("</nav>", 0), ('<div class="main">', 0), (f'<h1 class="hd">{word()} raises {word()}</h1>', 1)]
        rows += [(f"<p>{sentence()} {sentence()}", 1), (f"{sentence()}</p>", 1), ('<span class="promo">Sponsored</span>', 0), ('<h2 class="hd">Pricing</h2>', 1), (f"<p>{sentence()}</p>", 1)]
        rows += [("</div>", 0), ('<div class="foot">', 0), ('<p class="foot">Back to top</p>', 0), ('<p class="foot">Terms · Privacy · Imprint</p>', 0), ("</div>", 0), ("</body>", 0), ("</html>", 0)]
        if p % 5 == 4:  # the same, already reduced to text
            rows = [(x, 0) for x in NAV] + [(f"{word()} raises {word()}", 1), (f"{sentence()} {sentence()}", 1), ("Sponsored", 0), ("Pricing", 1), (f"{sentence()} {sentence()}", 1), ("", 0), ("Back to top", 0), ("Terms · Privacy · Imprint", 0)]
        pages.append((p, f"https://{'WWW.' if p % 3 else ''}Site.test/news/{p:03d}", "\n".join(r[0] for r in rows), "clash"))
        want |= {(p, i + 1) for i, r in enumerate(rows) if r[1]}
    return pages, want


def test_main_content(spark):
    pages, want = _site()
    extra = [(100, "https://site.test/news/100", None, ""), (101, "https://site.test/news/101", "  \n ", ""), (102, None, "x", "")]
    df = spark.createDataFrame(pages + extra, "page_id long, url string, payload string, host string")
    got = {tuple(r) for r in main_content(df).collect()}
    assert {g for g in got if g[0] < 100} == want
    assert not {g for g in got if g[0] in (100, 101)}
    again = spark.createDataFrame(pages + [(p + 50, u, t, x) for p, u, t, x in pages], df.schema)  # every page fetched twice
    assert {tuple(r) for r in main_content(again).collect()} == want | {(p + 50, n) for p, n in want}
    assert main_content(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [3, 16])
def test_neighbours_lie_anywhere(spark, monkeypatch, block):
    """Votes are those of brute force, whatever the blocks and partitions, one path with most of the pages included."""
    monkeypatch.setattr(boilerplate, "BLOCK", block)
    rng = random.Random(4)
    rows = []
    for p in range(120):
        path = "hot" if p % 3 == 0 else f"{rng.randrange(40):02d}"
        lines = [rng.choice(["Home", "Jobs", "Search", f"text {rng.randrange(60)} of {p}"]) for _ in range(rng.randrange(9))]
        rows.append((p, f"https://{'a' if p % 2 else 'b'}.test/{path}", "\n".join(lines)))
    rows += rows[:5]
    first = {}
    for p, u, t in sorted(rows):
        first.setdefault(u, (p, t))
    order = sorted(first)
    key = lambda t: [boilerplate.norm(x) for x in t.split("\n") if x.strip()]
    want = []
    for p, u, t in rows:
        k, mine = order.index(u), key(t)
        votes = [0] * len(mine)
        for j in range(max(0, k - 3), min(len(order), k + 4)):
            if j != k and order[j].split("/")[2] == u.split("/")[2]:
                theirs = key(first[order[j]][1])
                for a, b in common(mine, theirs) if k < j else common(theirs, mine):
                    votes[a if k < j else b] += 1
        want.append((p, tuple(votes)))
    df = spark.createDataFrame(rows, "page_id long, url string, payload string")
    for parts in (1, 8, 64):
        with_parts = df.repartition(parts)
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            got = [(r.page_id, tuple(r.votes)) for r in boilerplate.aligned(with_parts).collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert sorted(got) == sorted(want)


def test_leaks_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 8, 12, 30])))) for i in range(12)] + [(50, None), (51, "")]
    docs = []
    for k in range(120):
        t = " ".join(rng.choice(vocab) for _ in range(rng.randrange(40)))
        if rng.random() < 0.5:
            w = rng.choice(items[:12])[1].split()
            a = rng.randrange(len(w))
            t += " ~ " + rng.choice([", ", " ", "\n"]).join(w[a : a + rng.choice([4, 8, 15, 30])]).upper() + " tail"
        docs.append((k, rng.choice([t, t, None]) if k % 10 == 0 else t, "clash"))
    want = set()
    for d, t, _ in docs:
        for i, p in items:
            pw, tw = words(p or ""), words(t or "")
            grams = {tuple(tw[j : j + 8]) for j in range(len(tw) - 7)}
            hit = {q for j in range(len(pw) - 7) if tuple(pw[j : j + 8]) in grams for q in range(j, j + 8)}
            if hit and 2 * len(hit) >= len(pw):
                want.add((d, i))
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    it = spark.createDataFrame(items, "item_id long, passage string")
    assert {tuple(r) for r in find_leaks(df, it).collect()} == want and want
    assert find_leaks(df.limit(0), it).count() == 0 and find_leaks(df, it.limit(0)).count() == 0
    clean = remove_leaks(df, it)
    assert find_leaks(clean, it, share=1e-9).count() == 0
    same = {r.doc_id: r.text for r in clean.where("removed = 0").collect()}
    assert all(t == same[d] for d, t, _ in docs if d in same) and clean.count() == len(docs)


def test_leaks_are_cut_where_they_stand(spark):
    """Also where lower case is longer than the text (U+0130), against removal word by word."""
    ten = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, ten), (2, "İzmir b c d e f g h")], "item_id long, passage string")
    docs = [
        (1, f"İstanbul says {ten} end"), (2, f"İİİ {ten}"), (3, f"{ten.upper()}, İ"), (4, "x izmir B c, d e-f g\nh İ."), (5, "İZMİR b c d e f g"), (6, None), (7, ""), (8, f"a {ten} b {ten} c"),
        (9, "zero two three four five six seven eight nine tail"), (10, " ".join(["ß ẞ Σς"] * 3) + " " + ten),
    ]
    got = {r.doc_id: (r.text, r.removed) for r in remove_leaks(spark.createDataFrame(docs, "doc_id long, text string"), items, mark="#").collect()}
    n = len(ten)
    assert got[1] == ("İstanbul says # end", n) and got[2] == ("İİİ #", n) and got[3] == ("#, İ", n)
    assert got[4] == ("x # İ.", len("izmir B c, d e-f g\nh")) and got[5] == (docs[4][1], 0)
    assert got[6] == (None, 0) and got[7] == ("", 0) and got[8] == ("a # b # c", 2 * n)
    assert got[9] == ("zero # tail", len("two three four five six seven eight nine")) and got[10][1] == n


def test_leaks_cut_against_brute_force(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(3)] + ["İ", "Ünï"]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 4, 9])))) for i in range(6)]
    docs = [(k, "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randrange(60)))) for k in range(60)]
    grams = {tuple(w[j : j + 4]) for _, p in items for w in [words(p)] for j in range(len(w) - 3)}
    want = {}
    for d, t in docs:
        spans, ws = [m.span() for m in re.finditer(r"[^\W_]+", t)], words(t)
        gone = set()
        for j in range(len(ws) - 3):
            if tuple(ws[j : j + 4]) in grams:
                gone |= set(range(spans[j][0], spans[j + 3][1]))
        out = "".join("" if i in gone else c for i, c in enumerate(t))
        want[d] = (out, len(gone))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, passage string")
    assert {r.doc_id: (r.text, r.removed) for r in remove_leaks(df, it, n=4, mark="").collect()} == want and any(v[1] for v in want.values())


@pytest.mark.parametrize("capacity", [1, 7, 64, 512])
def test_plan_uses_every_item_once(capacity):
    r = np.random.default_rng(capacity)
    hist = {int(n): int(r.integers(1, 60)) for n in np.unique(r.integers(1, capacity + 1, 40))}
    runs, k = plan(capacity, hist)
    used, load = {}, {}
    for n, per, m, first in runs:
        used[n] = used.get(n, 0) + per * m
        for c in range(first, first + m):
            load[c] = load.get(c, 0) + n * per
    assert used == hist and sorted(load) == list(range(k)) and max(load.values()) <= capacity
    assert sum(load.values()) / (k * capacity) > 0.85


@pytest.mark.parametrize("capacity", [64, 512, 1500])
def test_combinations_earn_their_place(capacity):
    """Least squares over combinations needs no more containers than the greedy rest alone, and fewer where few items fill one."""
    r = np.random.default_rng(capacity)
    n = np.clip(r.lognormal(np.log(capacity / 2.5), 0.5, 40_000).astype(int), 1, capacity)
    hist = {int(k): int(c) for k, c in zip(*np.unique(n, return_counts=True), strict=True)}
    (_, ours), (_, greedy) = plan(capacity, hist), plan(capacity, hist, use_nnls=False)
    assert -(-int(n.sum()) // capacity) <= ours < greedy


def test_pack(spark):
    rng = random.Random(5)
    sizes = [(i, rng.choice([0, 3, 9, 9, 9, 20, 33, 64, 65, 200])) for i in range(600)]
    df = spark.createDataFrame(sizes + [(7, 9)], "doc_id long, tokens long")
    tg = spark.createDataFrame([(1, "a", 64), (2, "b", 20), (3, "c", None), (4, "d", 0)], "target_id int, label string, capacity_tokens long")
    rows = pack(df, tg).collect()
    for t, cap in ((1, 64), (2, 20)):
        own, load, per = [r for r in rows if r.target_id == t], {}, {}
        for r in own:
            load[r.container_id] = load.get(r.container_id, 0) + r.end_token - r.start_token
            per.setdefault(r.doc_id, []).append((r.piece_no, r.start_token, r.end_token))
        assert max(load.values()) <= cap and sum(load.values()) == sum(n for _, n in sizes) + 9
        for d, n in sizes:
            if n and d != 7:
                p = sorted(per[d])
                assert [x[0] for x in p] == list(range(-(-n // cap))) and p[-1][2] == n and all(a[2] == b[1] for a, b in zip(p, p[1:]))
    assert {r.target_id for r in rows} == {1, 2}
    assert pack(df.limit(0), tg).count() == 0 and pack(df, tg.limit(0)).count() == 0


def test_token_counts(spark):
    texts = [(1, "Hello world, twice: hello world."), (2, ""), (3, None), (4, "ü" * 5000), (None, "x")]
    enc = load_tokenizer()
    got = {r.doc_id: r.tokens for r in token_counts(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: len(enc.encode_ordinary(texts[0][1])), 4: len(enc.encode_ordinary(texts[3][1]))}


def test_em_recovers_reliable_labelers():
    rng = np.random.default_rng(0)
    z = rng.random(4000) < 0.3
    votes = np.stack([np.where(rng.random(4000) < acc, np.where(z, 1, -1), np.where(z, -1, 1)) for acc in (0.95, 0.9, 0.85, 0.55)], 1)
    pats, inv, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, rep = em(pats, n.astype(float))
    assert ((post[inv.ravel()] > 0.5) == z).mean() > 0.93
    assert rep["right"][0][2] > rep["right"][3][2]


GIVEN = "Kavra Xanith Brenko Dagov Fenelle Vessand Ulmisse Jorwyn Oruko Tavra".split()
FAMILY = "Astrich Chevwick Drommane Fennholt Grünmire Haskoux Ibarley Keszenko Lindasse Malvikov".split()
SAYS = ["{n}, founder of Ulton Labs, called it cheap.", '"No time," said {n}, chief executive at Ulton AI.', "{n} added that it stays open.", "\nBy {n}\n", "Dr {n} will lead the call.", "Mr. {n} doubts it."]
OTHER = ["Ulton Labs builds parsers in Port Ansel.", "Order no. 48-2210-5 was closed.", "Part 008-81-2624 fits Ulton Flow only.", "Analysts at Quenovo Capital expect more.", "The regulator in Marisca opened a review.", "Haskoux & Malvikov Capital signed in June."]


def _pii_docs(n=160):
    rng = random.Random(6)
    docs, want = [], []
    for d in range(n):
        text, spans = "", []

        def add(before, kind, span, after):
            nonlocal text
            text += before
            spans.append((kind, len(text), len(text) + len(span)))
            text += span + after

        for _ in range(4):
            a, b = rng.choice(GIVEN), rng.choice(FAMILY)
            x, y = rng.choice(SAYS).split("{n}")
            add(x, "name", rng.choice([f"{a} {b}", f"{a} K. {b}", f"{a} von {b}", f"{a.upper()} {b.upper()}"]), y + " ")
            text += rng.choice(OTHER) + " "
        add("and then ", "name", rng.choice(FAMILY), " spoke again. ")
        add("Write to ", "email", rng.choice(["a.b@c-d.test", "press at ulton dot eu dot test", "x_1(at)ulton(dot)test", "Q @ ulton.example"]), " for details. ")
        add("Call ", "phone", rng.choice(["+1-202-555-0191 ext. 304", "(808) 555 01 18 x95", "0049 30 23125341", "07700 900 918", "01.99.00.32.10", "030/23125-110"]), " on weekdays. ")
        add("Applicants must quote ", "id_number", "", "")
        spans.pop()
        lab, num = rng.choice([("SSN", "666 53 4924"), ("passport", "K0929839"), ("national id", "697216-7237Q"), ("tax id", "00 392 852 325")])
        add(lab + " ", "id_number", num, " on the form. ")
        add("Send samples to ", "address", rng.choice(["139 Norimo St\nNorthmere, OQ 19574", "PO Box 3995, Ostrave", "Unit 40, 102 Paxivo Court, Sankt Orben ZQ3 1XZ", "Norimostraße 28, 75761 Tarnwick", "89, rue de Mirbric, 67509 Quessant"]), ". ")
        docs.append((d, text, "clash"))
        want += [(d, *s) for s in spans]
    return docs, set(want)


def test_find_pii(spark):
    docs, want = _pii_docs()
    df = spark.createDataFrame(docs + [(900, None, ""), (901, "", "")], "doc_id long, text string, kind string")
    got = {tuple(r) for r in find_pii(df).collect()}
    missed, wrong = want - got, got - want
    assert len(missed) <= 0.03 * len(want) and len(wrong) <= 0.03 * len(want), (sorted(missed)[:5], sorted(wrong)[:5])
    out = {r.doc_id: (r.text, r.mentions) for r in mask_pii(df).collect()}
    assert out[900] == (None, 0) and out[901] == ("", 0) and "[EMAIL]" in out[0][0] and "@" not in re.sub(r"get @\S+", "", out[0][0])
    authors = spark.createDataFrame([("; ".join(f"{a} {b}" for a, b in zip(GIVEN, FAMILY)),)] * 3, "authors string")
    assert len({tuple(r) for r in find_pii(df, authors).collect()} ^ want) <= 0.06 * len(want)
    assert find_pii(df.limit(0)).count() == 0


def test_very_long_text_is_read_whole(spark):
    f, report = train(spark.createDataFrame(_pii_docs(60)[0], "doc_id long, text string, x string"))
    t = "filler words only here " * 40_000
    assert list(f.spans(pa.array([t + "mail a.b@c.test"]))) == [(0, "email", len(t) + 5, len(t) + 15)]
    # estimates and a plain majority differ where labelers are not equally reliable
    assert all(len(majority(x["votes"])) == len(x["posterior"]) for x in report.values()) and set(report) == {"email", "phone", "id_number", "address", "name"}
