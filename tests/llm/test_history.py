"""Deduplication of batches against history."""

import random

import numpy as np

from lodestrata.llm.history import DIMS, LEAST, HistoryIndex, _vectors, beam_search, build_graph, duplicates_of_history, edit_words, tune_beam


def _distance(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(q[-1] + 1, p[j] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_edit_words():
    rng = random.Random(1)
    for _ in range(800):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        most = rng.randrange(8)
        assert edit_words(a, b, most) == min(_distance(a, b), most + 1)


def test_beam_recall_against_exhaustive_search():
    r = np.random.default_rng(2)
    base = r.normal(size=(1500, DIMS))
    x = np.concatenate([base, base[:500] + 0.2 * r.normal(size=(500, DIMS))]).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = build_graph(x)
    width = tune_beam(x, links)
    q = x[1500:]
    want = (q @ x[:1500].T).argmax(1)
    if width:
        ids, _ = beam_search(x, links, q, width)
        assert (ids == want[:, None]).any(1).mean() >= 0.9


def _text(rng, n):
    return [rng.choice(VOCAB) for _ in range(n)]


VOCAB = [f"word{i}" for i in range(400)]


def _edited(rng, w, k):
    w = list(w)
    for _ in range(k):
        i = rng.randrange(len(w))
        c = rng.random()
        if c < 0.4:
            w[i] = "changed"
        elif c < 0.7:
            del w[i]
        else:
            w.insert(i, "added")
    return w


def _case(seed=3, n=240):
    rng = random.Random(seed)
    man, docs, texts = [], [], {}
    for i in range(n):
        batch = None if i == 3 else 0 if i < n // 2 else 1 + (i - n // 2) * 3 // n
        h = rng.choice([None, " ", "", f"sha256:{i:064x}"]) if rng.random() < 0.4 else f"{rng.randrange(60):064x}".upper() if rng.random() < 0.2 else f"{i:064x}"
        u = f"http{rng.choice(['', 's'])}://{rng.choice(['', 'www.'])}Host.test/p/{rng.randrange(150)}{rng.choice(['', '/', '?utm_source=x', '#top'])}" if rng.random() < 0.9 else rng.choice([None, "", " "])
        man.append((i, batch, h, u, "clash"))
        if rng.random() < 0.6:
            old = rng.choice(list(texts.values())) if texts and rng.random() < 0.5 else None
            w = _text(rng, rng.choice([3, 9, 12, 40, 90, 300])) if old is None else _edited(rng, old, rng.choice([0, 0, 1, len(old) // 10, len(old) // 5])) if len(old) > 5 else old
            texts[i] = w
            docs.append((i, rng.choice([" ", "  ", "\n"]).join(w)))
    return man, docs + [(None, "x y z"), (5000, "not in a manifest"), (1, None), (2, "  ")], texts


def _brute(man, texts):
    def url(u):
        if not u or not u.strip():
            return ""
        u = u.split("://", 1)[1].split("#")[0].replace("?utm_source=x", "")
        host, _, path = u.partition("/")
        return host.lower().removeprefix("www.") + "/" + path.rstrip("/")

    def digest(h):
        return (h or "").strip().lower().removeprefix("sha256:") or None

    out = {}
    for k, (i, b, h, u, _) in enumerate(man):
        for j, _, h2, u2, _ in man[:k]:
            same = digest(h) and digest(h) == digest(h2) or (not digest(h) or not digest(h2)) and url(u) and url(u) == url(u2)
            if not same and i in texts and j in texts:
                x, y = texts[i], texts[j]
                most = max(len(x), len(y)) // 10
                same = abs(len(x) - len(y)) <= most and _distance(x, y) <= most
            if same and (b or 0) > 0:
                out[i] = j
                break
    return out


def test_duplicates_against_brute_force(spark):
    man, docs, texts = _case()
    m = spark.createDataFrame(man, "manifest_id long, batch_no int, content_hash string, url string, id string")
    d = spark.createDataFrame(docs, "manifest_id long, text string")
    got = {r.manifest_id: r.kept_id for r in duplicates_of_history(m, d).collect()}
    want = _brute(man, texts)
    assert got == want and len(want) > 40
    assert {r.manifest_id: r.kept_id for r in duplicates_of_history(m.union(m), d.union(d)).collect()} == want
    assert duplicates_of_history(m.limit(0), d).count() == 0
    no_text = {k: v for k, v in _brute(man, {}).items()}
    assert {r.manifest_id: r.kept_id for r in duplicates_of_history(m, d.limit(0)).collect()} == no_text


def test_recurring_words_replaced_throughout(spark):
    """One word of a recurring phrase is replaced wherever it stands: all of the edits hit the heaviest word."""
    rng = random.Random(5)
    man, docs = [], []
    for k, n in enumerate((60, 120, 300) * 8):
        w = [f"t{k}w{rng.randrange(n)}" for _ in range(n)]
        for i in range(0, n - 1, 24):
            w[i : i + 2] = ["solar", "panel"]
        for j, v in enumerate((w, ["roof" if x == "panel" else x for x in w])):
            man.append((2 * k + j, j, None, f"https://h.test/{2 * k + j}"))
            docs.append((2 * k + j, " ".join(v)))
    m = spark.createDataFrame(man, "manifest_id long, batch_no int, content_hash string, url string")
    d = spark.createDataFrame(docs, "manifest_id long, text string")
    want = {(2 * k, 2 * k + 1) for k in range(24)}
    assert {tuple(r) for r in duplicates_of_history(m, d).collect()} == want
    assert {tuple(r) for r in duplicates_of_history(m, d, exact=True).collect()} == want


def test_cut_off_loses_no_pair():
    """Random edits, up to one word in ten: the cosine of the counts' roots never falls under the cut-off."""
    rng = random.Random(7)
    for _ in range(300):
        n = rng.randrange(10, 400)
        words = [f"w{min(int(rng.paretovariate(0.7)), 500)}" for _ in range(n)]
        heavy = max(set(words), key=words.count)
        other, k = list(words), n // 10
        for i in [i for i, x in enumerate(words) if x == heavy][:k] if rng.random() < 0.5 else rng.sample(range(n), k):
            other[i] = rng.choice(["new", "roof", "w1"])
        bags = np.stack([np.bincount([hash(x) % DIMS for x in v], minlength=DIMS) for v in (words, other)])
        a, b = _vectors(bags)
        assert a @ b >= LEAST


def test_long_counts_are_compared_exhaustively(spark):
    """Counts beyond what a vector holds: found all the same."""
    w = ["a"] * 70_000 + [f"w{i}" for i in range(30)]
    m = spark.createDataFrame([(1, 0, None, "https://h.test/1"), (2, 1, None, "https://h.test/2")], "manifest_id long, batch_no int, content_hash string, url string")
    d = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(w[:-20] + ["b"] * 400))], "manifest_id long, text string")
    assert [tuple(r) for r in duplicates_of_history(m, d).collect()] == [(1, 2)]


def test_index_over_batches(spark, tmp_path):
    rng = random.Random(8)
    index, texts, found, want, copies = HistoryIndex(spark, f"file://{tmp_path}/index"), {}, set(), set(), set()
    for b in range(3):
        new = []
        for i in range(b * 60, b * 60 + 60):
            old = rng.choice(list(texts)) if texts and rng.random() < 0.4 else None
            w = _text(rng, rng.choice([15, 60, 61, 200])) if old is None else _edited(rng, texts[old], len(texts[old]) // 20)
            same = next((j for j in range(i) if texts[j] == w), None)
            if same is not None:  # a copy repeats the first one, and is not indexed
                want.add((same, i))
                copies.add(i)
            else:
                for j, v in texts.items():
                    most = max(len(w), len(v)) // 10
                    if j not in copies and abs(len(w) - len(v)) <= most and _distance(w, v) <= most:
                        want.add((j, i))
            texts[i] = w
            new.append((i, " ".join(w)))
        df = spark.createDataFrame(new, "id long, text string")
        got = {(r.a, r.b) for r in index.add(df, b).collect()}
        if b == 1:  # a batch given again replaces itself; compaction leaves the older folders to readers
            assert {(r.a, r.b) for r in index.add(df, b).collect()} == got
            before = index.shards().count()
            assert index.compact() < before
        found |= got
    assert found == want and want and copies


def test_crowded_texts_lose_no_pair(spark):
    """Texts from one form, alike in most words: the ones within a tenth are found among all others that are nearly as near."""
    rng = random.Random(12)
    form, texts = _text(rng, 120), []
    for i in range(1800):
        if i >= 1500:
            texts.append(_edited(rng, texts[rng.randrange(1500)], 12))
        else:
            texts.append([f"x{rng.randrange(5000)}" if rng.random() < 0.14 else w for w in form])
    m = spark.createDataFrame([(i, int(i >= 1500), None, f"https://h.test/{i}") for i in range(len(texts))], "manifest_id long, batch_no int, content_hash string, url string")
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "manifest_id long, text string")
    want = {}
    for i in range(1500, len(texts)):
        for j in range(i):
            most = max(len(texts[i]), len(texts[j])) // 10
            if abs(len(texts[i]) - len(texts[j])) <= most and edit_words(texts[j], texts[i], most) <= most:
                want[i] = j
                break
    assert {r.manifest_id: r.kept_id for r in duplicates_of_history(m, d).collect()} == want and len(want) > 200


def test_tiles_of_all_widths():
    """Pairs of a tile equal those of plain comparison, also where the two sides count their words in different numbers of classes."""
    from lodestrata.llm.history import _few_edits, _folded, match_tile

    rng = np.random.default_rng(4)
    rows = rng.poisson(0.8, (700, 128)).astype(np.uint16)
    mine = rows[rng.integers(0, 700, 900)].astype(np.int64)
    mine[np.arange(900), rng.integers(0, 128, 900)] += rng.integers(0, 14, 900)
    mine = mine.astype(np.uint16)
    m, n = rows.sum(1, dtype=np.int64), mine.sum(1, dtype=np.int64)
    key, of = np.arange(2000, 2900), np.arange(700) * 4
    for x in (mine, _folded(mine, 64)):
        y, got = _folded(rows, x.shape[1]), {tuple(p) for p in match_tile(key, n, x, of, m, rows)}
        i, j = (v.ravel() for v in np.meshgrid(np.arange(900), np.arange(700), indexing="ij"))
        longer = np.maximum(n[i], m[j])
        ok = (of[j] < key[i]) & (abs(n[i] - m[j]) <= longer // 10) & _few_edits(x, i, y, j, longer // 10)
        assert got == set(zip(i[ok].tolist(), j[ok].tolist(), strict=True)) and len(got) > 300
