"""Operators on texts do not depend on how many texts there are."""

import random
import re

import pyarrow as pa
import pytest

from lodestrata.llm import pii


def test_votes_come_from_all_texts(spark, monkeypatch):
    common = [(i, f"Call {i} was made by someone, write to user{i}@host.test or phone +49 30 {1000000 + i}.") for i in range(300)]
    rare = (1000, "She lives at 12 Mill Lane, Ludovia")
    df = spark.createDataFrame([*common, rare], "doc_id long, text string")
    monkeypatch.setattr(pii, "TRAIN_DOCS", 3, raising=False)
    pattern = [(k, v) for _, k, _, _, v, _ in pii._candidates(pa.array([rare[1]]))]
    assert [k for k, _ in pattern] == ["address"]
    _, report = pii.train(df)
    assert report["address"]["votes"].tolist() == [list(pattern[0][1])] and report["phone"]["counts"].sum() == 300
    assert [(r.kind, rare[1][r.start_pos : r.end_pos]) for r in pii.find_pii(df).where("doc_id = 1000").collect()] == [("address", "12 Mill Lane, Ludovia")]


def test_models_come_from_all_texts(spark, monkeypatch):
    """No limit on texts, words or spans: tokens beside names, counts and models are those of the whole table."""
    people = [f"{a}{b} {c}{d}son" for a in ("Al", "Be", "Ca") for b in ("ma", "no") for c in ("Vi", "Ko", "Re") for d in ("nt", "ld")]
    texts = [(i, f"Yesterday chairwoman {people[i % 36]} spoke and then {people[i * 7 % 36]} left. The Old Harbour {i} stayed shut.") for i in range(300)]
    df, authors = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([("; ".join(people),)] * 3, "authors string")
    for name in ("TRAIN_DOCS", "TRAIN_WORDS", "TRAIN_SPANS"):
        monkeypatch.setattr(pii, name, 3, raising=False)
    finder, report = pii.train(df, authors)
    assert finder.ctx.before["chairwoman"] == 1 and finder.ctx.after[" left"] == 1 and report["name"]["counts"].sum() >= 600
    want = {(i, *m.span()) for i, t in texts for m in re.finditer("|".join(people), t)}
    got = {(r.doc_id, r.start_pos, r.end_pos) for r in pii.find_pii(df, authors).collect() if r.kind == "name"}
    assert len(want) == 600 and len(want ^ got) <= 0.02 * len(want)


def test_fit_in_tasks_equals_fit_in_the_driver(spark, monkeypatch):
    rng = random.Random(3)
    rows = spark.createDataFrame([([rng.randrange(50) for _ in range(rng.randrange(1, 6))], [rng.random(), rng.random()], float(rng.randrange(1, 21))) for _ in range(200)], "x array<int>, y array<double>, weight double")
    here = pii.fit(rows, 2, 6)
    monkeypatch.setattr(pii, "FIT_ROWS", 0)
    assert abs(here).max() > 0.1 and abs(pii.fit(rows, 2, 6) - here).max() < 1e-5


def test_every_address_shape_passes_the_prefilter():
    tails = [", 10115 Berlin", "\n10115 Berlin", " 10115 Berlin", " - 12345 Town", ", Ludovia", "\nLudovia"]
    kinds = "Street St St. Road Rd Rd. Lane Court Avenue Ave Way Square Close Drive Terrace Place Boulevard Blvd Crescent Row".split()
    heads = [f"12 Mill{b}{k}" for k in kinds for b in " \n "]
    heads += [f"Flat 3, Mill{b}{k}" for k in "House Building Tower Hall".split() for b in " \n"]
    heads += [f"Mill{k}{b}5" for k in "straße strasse str. weg platz gasse allee ufer ring damm".split() for b in " \n"]
    heads += ["PO\nBox 5", "Postfach 5", "BP\n5", "Apartado 5"]
    heads += [f"5{b}{k} Mill" for k in "rue avenue boulevard place chemin allée impasse quai cours".split() for b in " \n"]
    heads += [f"{k}{b}Mill, 5" for k in "Calle C/ Avenida Avda. Av. Plaza Pza. Paseo Camino Ronda".split() for b in (" ", "\n", " de ", "de ")]
    shapes = [h + t for h in heads for t in tails]
    taken = [x for x in shapes if pii._ADDRESS.search(x)]
    assert len(taken) > len(shapes) / 2
    found = {i for i, k, *_ in pii._candidates(pa.array(taken)) if k == "address"}
    assert [x for i, x in enumerate(taken) if i not in found] == []


@pytest.mark.parametrize("kind", pii.KINDS)
def test_native_patterns_are_implied(kind):
    """Whatever the exact pattern finds in made-up texts, the native one lets through."""
    rng = random.Random(kind)
    bits = {
        "email": ["a.b+c", "@", " @ ", " at ", "(at)", "[ ät ]", "x-y", ".", " dot ", "{dot}", "test", "\u00a0", "É", "_", "mailto:"], "phone": ["+49", "00", "(0)", " ", "-", "/", "030", "55501", "07", "(202)", " ext. 5", "x9", "12", "\u00a0", "٣"],
        "id_number": ["000", "-", " ", "12", "3456", "AB", "C", "9", "123456789", "K", "\u00a0", "."], "address": ["12", " ", "Mill", "\n", "St", " Road", ", ", "Ludovia", "rue de ", "Calle ", "n.º ", "PO Box ", "straße", "75761", "b", " - ", "\u00a0"],
    }[kind]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(2, 12))) for _ in range(20_000)]
    found = {i for i, k, *_ in pii._candidates(pa.array(texts)) if k == kind}
    want = {i for i, t in enumerate(texts) if pii._PATTERNS[kind].search(t)}
    assert want and want <= found
    if kind == "email":
        assert all([m.span() for m in pii._mails(t)] == [m.span() for m in pii._EMAIL.finditer(t)] for t in texts)


def test_mentions_of_any_length(spark):
    """No window cuts a mention: long addresses are found and masked whole, neighbours do not shorten a number."""
    long = ["a" * 130 + "@host.example", "b." * 90 + "c@" + "d" * 60 + ".example"]
    streets = ["12 Main St 12345 Springfield", "12 Rose Way 12345 Springfield", "12 Oak Drive 12345 Dover", "9 Elm Close 54321 Dover", "5 Park Place 54321 Dover"]
    texts = [f"Write to {x} today." for x in long] + [f"Address: {x}." for x in streets] + ["Tel. +14065550172\nCall 030/23125-110 on weekdays."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.kind): texts[r.doc_id][r.start_pos : r.end_pos] for r in pii.find_pii(df).collect() if r.kind in ("email", "address")}
    assert got == {(i, "email"): x for i, x in enumerate(long)} | {(i + 2, "address"): x for i, x in enumerate(streets)}
    assert sorted(texts[7][r.start_pos : r.end_pos] for r in pii.find_pii(df).where("doc_id = 7").collect()) == ["+14065550172", "030/23125-110"]
    assert {r.doc_id: r.text for r in pii.mask_pii(df).collect()}[1] == "Write to [EMAIL] today."


def test_slices_make_no_difference(spark, monkeypatch):
    texts = [f"Dr Lena Moor{i % 7} said that {c} 🙂 é\x00 Lena Moor{i % 7}" for i, c in enumerate("abcdefgh" * 6)] + ["", " ", "."]
    a = pa.array(texts)
    whole = pii.Words(a)
    want = [(int(d), int(s), int(e), whole.vocab[w]) for d, s, e, w in zip(whole.doc, whole.start, whole.end, whole.w)]
    assert all(texts[d][s:e] == w for d, s, e, w in want)
    monkeypatch.setattr(pii, "SLICE", 100)
    parts = [(n + int(d), int(s), int(e), x.vocab[w]) for n, p in pii._slices(a) for x in [pii.Words(p)] for d, s, e, w in zip(x.doc, x.start, x.end, x.w)]
    assert parts == want
