"""The general data problems: packed fields, repeated deliveries, timestamp texts."""

import datetime as dt
import random
import uuid

import numpy as np
import pytest

from lodestrata.operators.instants import parse_batch, to_instants
from lodestrata.operators.packed_fields import unpack
from lodestrata.operators import redelivery
from lodestrata.operators.redelivery import DeliveryLedger, surplus_deliveries

PACKED = [
    ('["a, b", "c \\"x\\" d"]', ["a, b", 'c "x" d']),
    ('"U ""N"" F" | "A, Ltd." ', ['U "N" F', "A, Ltd."]),
    ('Dov "Blue" Fund;Ult Fund ; ', ['Dov "Blue" Fund', "Ult Fund"]),
    ("'G \"E\" F';'Q & N'", ['G "E" F', "Q & N"]),
    ("1) A & B 2) Salt and X 3) C", ["A & B", "Salt and X", "C"]),
    ("* a\n* b, c", ["a", "b, c"]),
    ("A B, C D, and E F", ["A B", "C D", "E F"]),
    ("A B, C D & E F", ["A B", "C D", "E F"]),
    ("a;;b", ["a", "b"]),
    ('A, "B and C", D', ["A", "B and C", "D"]),
    ('"A, B"', None),
    ("one", None),
    ("", None),
    ("  ", None),
    (None, None),
    ("[broken; x", ["[broken", "x"]),
    ('x; "open', ["x", '"open']),
    ('a\ue0000\ue001b; "c; d"; \ue002a\ue000; \ue002', ["a\ue0000\ue001b", "c; d", "\ue002a\ue000", "\ue002"]),
    ("; ".join(["v" * 50] * 2000), ["v" * 50] * 2000),
]


def _lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.id, r.pos)):
        out.setdefault(r.id, []).append(r.item)
        assert r.pos == len(out[r.id])
    return out


@pytest.mark.parametrize("conjunction", ["always", "list_end"])
def test_unpack_cases(spark, conjunction):
    df = spark.createDataFrame([(i, f, "clash", "clash") for i, (f, _) in enumerate(PACKED)], "id int, f string, pos string, item string")
    got = _lists(unpack(df, ["id"], "f", conjunction))
    assert got == {i: v for i, (_, v) in enumerate(PACKED) if v}


def test_unpack_conjunctions(spark):
    df = spark.createDataFrame([(0, "A and B"), (1, "A, B and C"), (2, "Ruv, Bre")], "id int, f string")
    assert _lists(unpack(df, ["id"], "f", "always")) == {0: ["A", "B"], 1: ["A", "B", "C"]}
    assert _lists(unpack(df, ["id"], "f", "list_end")) == {1: ["A", "B", "C"], 2: ["Ruv", "Bre"]}
    assert _lists(unpack(df, ["id"], "f", "never")) == {1: ["A", "B and C"], 2: ["Ruv", "Bre"]}
    with pytest.raises(ValueError):
        unpack(df, ["id"], "f", "never", pos="id")
    assert unpack(df.limit(0), ["id"], "f").count() == 0


def _messages(n, seed=3):
    rng = random.Random(seed)
    ids = [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(n // 2)]
    spell = [str, str.upper, lambda s: s.replace("-", ""), lambda s: "{" + s + "}", lambda s: "urn:uuid:" + s, lambda s: " " + s + " "]
    rows = []
    for i in range(n):
        u = ids[0] if rng.random() < 0.3 else rng.choice(ids)
        m = rng.choice([None, "", "  "]) if rng.random() < 0.05 else rng.choice(spell)(u)
        t = None if rng.random() < 0.05 else dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(minutes=rng.randrange(100_000))
        rows.append((i, m, rng.choice([None, 0, 1, 2]), t, "clash"))
    return rows


def _key(m):
    s = "".join((m or "").lower().split())
    return s.replace("urn:", "").replace("uuid:", "").strip("{}").replace("-", "") or None


def _expected(rows):
    best = {}
    for rid, m, att, *_ in rows:
        if k := _key(m):
            best[k] = min(best.get(k, (True, 9, 1 << 60)), (att is None, att or 0, rid))
    return sorted(rid for rid, m, att, *_ in rows if _key(m) and best[_key(m)][2] != rid)


SCHEMA = "entry_id long, message_id string, attempt int, received_at timestamp, uid string"


@pytest.mark.parametrize("bits", [32, 1])
def test_surplus_deliveries(spark, monkeypatch, bits):
    monkeypatch.setattr(redelivery, "BITS_PER_ID", bits)
    rows = _messages(3000)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r[0] for r in surplus_deliveries(df).collect()) == _expected(rows)
    assert sorted(r[0] for r in surplus_deliveries(df.union(df)).collect()) == _expected(rows)
    assert surplus_deliveries(df.limit(0)).count() == 0


def test_screen_lets_new_ones_go():
    r = np.random.default_rng(0)
    h = r.integers(-(1 << 63), 1 << 63, 20_000, dtype=np.int64)
    bucket, n = r.integers(0, 8, 20_000), np.ones(20_000, np.int64)
    n[:50] = 2
    twice = h[100:150]
    got = set(redelivery.screen(np.append(h, twice), np.append(bucket, (bucket[100:150] + 1) % 8), np.append(n, np.ones(50, np.int64))).tolist())
    assert set(h[:50].tolist()) | set(twice.tolist()) <= got and len(got) < 1000


def test_ledger_over_batches(spark, tmp_path):
    rows = _messages(1200, 5)
    ledger, kept, surplus = DeliveryLedger(spark, f"file://{tmp_path}/ledger"), set(), []
    for k in range(3):
        part = rows[k * 400 : (k + 1) * 400]
        got = {r[0] for r in ledger.accept(spark.createDataFrame(part, SCHEMA), k).collect()}
        if k == 1:  # a batch given again is not held against itself
            assert {r[0] for r in ledger.accept(spark.createDataFrame(part, SCHEMA), k).collect()} == got
        surplus += got
        for rid, m, *_ in part:
            if _key(m) and rid not in got:
                assert _key(m) not in kept
                kept.add(_key(m))
    assert len(kept) == len({_key(r[1]) for r in rows if _key(r[1])})


UTC = dt.timezone.utc


def _us(*a, us=0):
    return int(dt.datetime(*a, tzinfo=UTC).timestamp()) * 10**6 + us


BER = ("Europe/Berlin", "dmy")
NY = ("America/New_York", "mdy")
TIMES = [
    ("2022-02-24T19:35:22.418684586Z", None, None, _us(2022, 2, 24, 19, 35, 22, us=418684)),
    ("2022-05-20T03:41:33,540+02:00", *BER, _us(2022, 5, 20, 1, 41, 33, us=540000)),
    ("2024-12-27T19:11:25+01:00[Europe/Berlin]", None, None, _us(2024, 12, 27, 18, 11, 25)),
    ("20220304T002135Z", None, None, _us(2022, 3, 4, 0, 21, 35)),
    ("20230117", *BER, _us(2023, 1, 16, 23)),
    ("1651720554", None, None, 1651720554 * 10**6),
    ("1700523867942", None, None, 1700523867942000),
    ("1759594757271889", None, None, 1759594757271889),
    ("Thu, 09 Mar 2023 06:56:51 GMT", None, None, _us(2023, 3, 9, 6, 56, 51)),
    ("Friday, 01-Apr-22 13:07:17 GMT", None, None, _us(2022, 4, 1, 13, 7, 17)),
    ("Sun Apr 16 14:25:58 EDT 2023", None, None, _us(2023, 4, 16, 18, 25, 58)),
    ("30 Oct 2022 08:21:32 UTC+7", None, None, _us(2022, 10, 30, 1, 21, 32)),
    ("11/05/2024 11:56:55 PM", *NY, _us(2024, 11, 6, 4, 56, 55)),
    ("11/05/2024 11:56", *BER, _us(2024, 5, 11, 9, 56)),
    ("11/05/2024 11:56", "UTC", None, None),
    ("12/25/2025 12:05:00 AM", *NY, _us(2025, 12, 25, 5, 5)),
    ("Stand: 31. März 2025, 23:00 Uhr", *BER, _us(2025, 3, 31, 21)),
    ("17 janvier 2023 à 23h45", "UTC", None, _us(2023, 1, 17, 23, 45)),
    ("June 24, 2023 7:09 AM UTC", None, None, _us(2023, 6, 24, 7, 9)),
    ("Oct 11, 2023 at 7:36 pm", "America/Los_Angeles", "mdy", _us(2023, 10, 12, 2, 36)),
    (" 2022-08-08 17:11:28\n", "Asia/Kolkata", "dmy", _us(2022, 8, 8, 11, 41, 28)),
    ("about 11 HOURS AGO", None, None, _us(2024, 5, 1) - 11 * 3600 * 10**6),
    ("2024-10-27 02:30:00", *BER, None),  # twice
    ("2024-03-31 02:30:00", *BER, None),  # never
    ("2024-10-27 02:30:00 CEST", *BER, _us(2024, 10, 27, 0, 30)),
    ("2022-10-29", None, None, None),
    ("2023-02-30T10:00:00Z", *BER, None),
    ("31/11/2024 09:00", *BER, None),
    ("0000-00-00 00:00:00", *BER, None),
    ("2024-01-01 25:00:00", *BER, None),
    ("01/01/2024 13:00:00 PM", *BER, None),
    ("Mon, 99 Foo 2024", *BER, None),
    ("soon", *BER, None),
    ("x" * 100_000, *BER, None),
    ("2022-02-24T19:35:22." + "123456" + "0" * 200 + "Z", None, None, _us(2022, 2, 24, 19, 35, 22, us=123456)),
    ("2022-02-24" + " " * 100_000 + "19:35:22" + " " * 100_000 + "Z" + " " * 100_000, None, None, _us(2022, 2, 24, 19, 35, 22)),
    ("2022-02-24" + " " * 100_000 + "19:35:22" + " " * 100_000 + "x", None, None, None),
    ("", *BER, None),
    (None, *BER, None),
]


def test_parse_texts():
    at = _us(2024, 5, 1)
    got = parse_batch([t[0] for t in TIMES], [t[1] for t in TIMES], [t[2] for t in TIMES], [at] * len(TIMES))
    assert [(t[0], g) for t, g in zip(TIMES, got)] == [(t[0], t[3]) for t in TIMES]
    assert parse_batch(["3 days ago"], [None], [None], [None]) == [None]


def test_random_instants_round_trip():
    rng = random.Random(1)
    raw, want = [], []
    for _ in range(3000):
        t = dt.datetime(1970, 1, 1, tzinfo=UTC) + dt.timedelta(seconds=rng.randrange(-(10**10), 10**10), microseconds=rng.randrange(10**6))
        off = dt.timezone(dt.timedelta(minutes=rng.randrange(-720, 841, 15)))
        raw.append(t.astimezone(off).isoformat(sep=rng.choice("T ")))
        want.append((t - dt.datetime(1970, 1, 1, tzinfo=UTC)) // dt.timedelta(microseconds=1))
    assert parse_batch(raw, [None] * 3000, [None] * 3000, [None] * 3000) == want


def test_to_instants_frame(spark):
    df = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", "x", None), (1, "2024-01-01T00:00:00Z", "x", None), (2, None, "x", None), (3, "1 day ago", "x", dt.datetime(2024, 1, 2))], "id int, raw string, k0 string, at timestamp")
    got = sorted(map(tuple, to_instants(df, ["id"], "raw", fetched_at="at").collect()))
    assert got == [(1, _us(2024, 1, 1))] * 2 + [(3, _us(2024, 1, 1))]
    assert to_instants(df.limit(0), ["id"], "raw").count() == 0
