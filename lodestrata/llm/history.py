"""Deduplicating new batches against all history.

Hashes and addresses are matched by aggregation. Texts become short vectors, the square roots of their hashed word counts.
Over a whole table (``duplicates_of_history``) they are compared in tiles of the texts whose lengths allow it, exhaustively: at
these sizes a matrix product costs less than a walk through a graph, and loses nothing. Batch by batch (``HistoryIndex``) they
are matched through graph index shards by length band and arrival: each shard is a navigable small-world graph (nearest
neighbours plus random long links). The beam of a shard is widened until it finds what exhaustive search finds on a probe of the
shard's own rows; where no beam does, the shard is searched exhaustively. A batch adds a shard a band; small shards are compacted
into one. Candidates are reranked exactly, by the number of words to be added, removed or replaced.

The cut-off of the search loses no pair: k edits leave at least max(n, m) - k words in common, hashing words together and
taking square roots never lower the overlap, so the cosine of two texts of n and m words is at least
(max(n, m) - k) / sqrt(n m), which is 0.9 or more where k is a tenth of the longer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..session import discard, path_exists, stage

#: Classes that words are hashed into.
DIMS = 128
#: Rows of a shard (its task holds them all), links to nearest rows, long links, rows of a block of queries.
SHARD_ROWS, NEAR, LONG, BLOCK = 8192, 10, 4, 8192
#: Recall that a beam must reach on the probe; widest beam.
RECALL, WIDEST = 0.99, 128
#: Edits for each word of the longer text, and the least similarity of vectors that they leave (less what rounding takes).
EDITS = 0.1
LEAST = 1 - EDITS - 2e-3
#: Texts with more words may have counts that do not fit a vector; they are compared with all rows of their shards.
MOST_WORDS = 65_535
#: Texts of one length band differ in length by less than this factor.
BAND = 1.25
#: Tiles: texts of one strip differ in length by less than this factor; word counts of a side of a tile; rows that are multiplied at once.
STRIP, TILE, STEP = 1.05, 1 << 22, 512
#: Classes that the words of a text of a tile are hashed into, by the least number of words.
WIDTHS = ((0, 64), (100, 128), (200, 256), (400, 512), (800, 1024))


def _slices(batch: pd.DataFrame, text: str, most: int = 4 << 20):
    """The batch in parts of about so many characters, so that long texts do not add up in memory."""
    part = np.cumsum(batch[text].str.len().to_numpy(np.int64)) // most
    for s in np.unique(part):
        yield batch[part == s]


def _width(n: np.ndarray) -> np.ndarray:
    return np.array([w for _, w in WIDTHS], np.int64)[np.searchsorted([x for x, _ in WIDTHS], n, "right") - 1]


def embed_texts(docs: DataFrame, key: str, text: str, tiles: bool = False) -> DataFrame:
    """``key, same, n, bag``: identity (hash of the words), number of words and hashed word counts of each text, ``DIMS`` of them or,
    for ``tiles``, as many as ``WIDTHS`` has for its length.

    Whole texts in one narrow pass; words are what white space separates. Texts without words give no row.
    """
    import hashlib

    def run(batches):
        for b in (x for batch in batches for x in _slices(batch, "t")):
            words = [t.split() for t in b["t"]]
            n = np.array([len(w) for w in words], np.int64)
            flat = np.array([x for w in words for x in w], dtype=object)
            if not len(flat):
                continue
            h = pd.util.hash_array(flat, categorize=True)
            doc = np.repeat(np.arange(len(b)), n)
            width = _width(n) if tiles else np.full(len(b), DIMS)
            end = np.cumsum(width)
            place = (end - width)[doc] + (h >> (64 - np.log2(width).astype(np.uint64))[doc]).astype(np.int64)
            bag = np.minimum(np.bincount(place, minlength=end[-1]), 65535).astype(np.uint16)
            ident = [hashlib.blake2b(" ".join(w).encode("utf-8", "surrogatepass"), digest_size=16).digest() for w in words]
            keep = np.flatnonzero(n)
            yield pd.DataFrame({"key": b["key"].to_numpy()[keep], "same": [ident[i] for i in keep], "n": n[keep], "bag": [bag[end[i] - width[i] : end[i]].tobytes() for i in keep]})

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("t")).where("key IS NOT NULL AND t IS NOT NULL").mapInPandas(run, "key long, same binary, n long, bag binary")


# ---- one shard ----------------------------------------------------------------------------------------------------


def build_graph(x: np.ndarray, seed: int = 7) -> np.ndarray:
    """Links of every row: its nearest rows, rows it is nearest to, and random long links. Rows of -1 pad."""
    n = len(x)
    k = min(NEAR, n - 1)
    if k <= 0:
        return np.full((n, 1), -1, np.int32)
    near = np.empty((n, k), np.int32)
    for s in range(0, n, 1024):
        sim = x[s : s + 1024] @ x.T
        sim[np.arange(len(sim)), np.arange(s, s + len(sim))] = -2
        near[s : s + 1024] = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    rng = np.random.default_rng(seed)
    long = rng.integers(0, n, (n, LONG), dtype=np.int32)
    # back links from each row's neighbours, so that no row is without a way in
    src, dst = np.repeat(np.arange(n, dtype=np.int32), k), near.ravel()
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    first = np.searchsorted(dst, np.arange(n))
    rank = np.arange(len(dst)) - first[dst]
    back = np.full((n, NEAR), -1, np.int32)
    fits = rank < NEAR
    back[dst[fits], rank[fits]] = src[fits]
    return np.concatenate([near, back, long], axis=1)


def beam_search(x: np.ndarray, links: np.ndarray, q: np.ndarray, width: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Rows and similarities (len(q), width) of a beam search, all queries in step."""
    n, m = len(x), len(q)
    width = min(width, n)
    rng = np.random.default_rng(seed)
    start = rng.choice(n, size=min(n, max(width, 24)), replace=False)
    sim = q @ x[start].T
    top = np.argpartition(-sim, width - 1, axis=1)[:, :width]
    ids, sims = start[top].astype(np.int64), np.take_along_axis(sim, top, 1)
    done = np.zeros((m, width), bool)
    live = np.arange(m)
    for _ in range(4 * width + 16):
        open_ = np.where(done[live], -3.0, sims[live])
        step = min(3, width)
        best = np.argpartition(-open_, step - 1, axis=1)[:, :step]
        go = np.take_along_axis(open_, best, 1) > -3
        some = go.any(1)
        live, best, go = live[some], best[some], go[some]
        if not len(live):
            break
        r = np.arange(len(live))[:, None]
        nodes = ids[live][r, best]
        done[live[:, None], best] = True
        nb = np.where(go[:, :, None], links[nodes], -1).reshape(len(live), -1).astype(np.int64)
        got = np.einsum("qd,qkd->qk", q[live], x[nb], optimize=False)
        got[nb < 0] = -3
        # one copy of each row, the visited one first
        key = np.concatenate([ids[live] * 2 + ~done[live], np.where(nb < 0, n, nb) * 2 + 1], 1)
        val = np.concatenate([sims[live], got], 1)
        order = np.argsort(key, axis=1, kind="stable")
        key, val = np.take_along_axis(key, order, 1), np.take_along_axis(val, order, 1)
        val[:, 1:][key[:, 1:] >> 1 == key[:, :-1] >> 1] = -3
        top = np.argpartition(-val, width - 1, axis=1)[:, :width]
        key, val = np.take_along_axis(key, top, 1), np.take_along_axis(val, top, 1)
        ids[live], sims[live], done[live] = np.minimum(key >> 1, n - 1), val, (key & 1 == 0) | (val <= -3)
    return ids, sims


def tune_beam(x: np.ndarray, links: np.ndarray, probe: int = 96, seed: int = 5) -> int:
    """Narrowest beam (16, 32, ...) that finds, for a probe of the shard's rows, the nearest other row; 0: only exhaustive search does."""
    n = len(x)
    if n <= 64:
        return 0
    p = np.random.default_rng(seed).choice(n, size=min(n, probe), replace=False)
    sim = x[p] @ x.T
    sim[np.arange(len(p)), p] = -2
    want, at = sim.max(1), sim.argmax(1)
    width = 16
    while width <= min(WIDEST, n):
        ids, _ = beam_search(x, links, x[p], width)
        hit = (ids == at[:, None]).any(1) | (want < LEAST)  # what is too far away is no candidate
        if hit.mean() >= RECALL:
            return width
        width *= 2
    return 0


def _few_edits(p: np.ndarray, i: np.ndarray, q: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Whether the word counts of rows i of p and j of q allow so few edits: one edit changes two counts by one at most. No pair
    is lost by it."""
    out = np.empty(len(i), bool)
    for s in range(0, len(i), 32768):  # bounds the gathered rows
        part = slice(s, s + 32768)
        out[part] = np.abs(p[i[part]].astype(np.int32) - q[j[part]]).sum(1) <= 2 * most[part]
    return out


def search(x: np.ndarray, links: np.ndarray, width: int, q: np.ndarray, least: float = LEAST) -> np.ndarray:
    """(query, row) of all pairs with at least ``least`` similarity, as the tuned beam finds them; width 0: all there are."""
    out: list[np.ndarray] = [np.empty((0, 2), np.int64)]
    rest = [np.arange(len(q))] if not width else []
    for s in range(0, len(q), 1024) if width else ():  # bounds the gathered neighbours
        ids, sims = beam_search(x, links, q[s : s + 1024], width)
        hit = sims >= least
        full = hit.all(1)  # the beam may hold too few: such queries are searched exhaustively
        a, b = np.nonzero(hit & ~full[:, None])
        out.append(np.stack([s + a, ids[a, b]], 1))
        rest.append(s + np.flatnonzero(full))
    rest = np.concatenate(rest)
    for s in range(0, len(rest), 1024):
        i, j = np.nonzero(q[rest[s : s + 1024]] @ x.T >= least)
        out.append(np.stack([rest[s + i], j], 1))
    return np.concatenate(out)


# ---- shards of a table --------------------------------------------------------------------------------------------


def _bags(col) -> np.ndarray:
    return np.frombuffer(b"".join(col), np.uint16).reshape(-1, DIMS)


def _vectors(bags: np.ndarray) -> np.ndarray:
    v = np.sqrt(bags.astype(np.float32))
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


_SHARD = "band int, seg int, ids binary, sizes binary, bags binary, links binary, beam int"


def build_shards(rows: DataFrame) -> DataFrame:
    """One row a shard: its keys, word counts, links and tuned beam. ``rows``: band, seg, key, n, bag."""

    def build(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("key")
        x = _vectors(_bags(g["bag"]))
        links = build_graph(x)
        beam = 0 if g["n"].max() > MOST_WORDS else tune_beam(x, links)
        return pd.DataFrame([{"band": g["band"].iloc[0], "seg": g["seg"].iloc[0], "ids": g["key"].to_numpy(np.int64).tobytes(), "sizes": g["n"].to_numpy(np.int64).tobytes(), "bags": b"".join(g["bag"]), "links": links.tobytes(), "beam": beam}])

    return rows.select("band", "seg", "key", "n", "bag").groupBy("band", "seg").applyInPandas(build, _SHARD)


def search_shards(queries: DataFrame, shards: DataFrame, exact: bool = False) -> DataFrame:
    """``a, b``: candidate pairs (a < b) of the queries (key, n, bag) and the shards' rows.

    A query visits the bands that a text with at most one word in ten changed can be in. Queries go in blocks; the shard's row
    is copied once a block. ``exact`` searches every shard exhaustively: no pair is lost.
    """
    band = lambda n: F.floor(F.log(n) / F.log(F.lit(BAND))).cast("int")
    q = queries.select("key", "n", "bag", F.explode(F.sequence(band(F.col("n") * (1 - EDITS)), band(F.col("n") / (1 - EDITS)))).alias("band"))
    where = shards.select("band", F.col("seg").alias("s"))
    blocks = q.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    q = q.join(blocks, "band").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    visits = q.join(where, "band").select("band", F.col("s").alias("seg"), "block", "key", "n", "bag")
    copies = shards.join(blocks, "band").select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).drop("blocks")

    def visit(keys, s: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(s) or not len(v):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        r = s.iloc[0]
        ids, rows, mine = np.frombuffer(r["ids"], np.int64), _bags([r["bags"]]), _bags(v["bag"])
        sizes, n = np.frombuffer(r["sizes"], np.int64), v["n"].to_numpy(np.int64)
        links = np.frombuffer(r["links"], np.int32).reshape(len(ids), -1)
        least = LEAST if max(sizes.max(), n.max()) <= MOST_WORDS else -2.0
        i, j = search(_vectors(rows), links, 0 if exact else int(r["beam"]), _vectors(mine), least).T
        a, b = v["key"].to_numpy(np.int64)[i], ids[j]
        longer = np.maximum(n[i], sizes[j])
        keep = np.flatnonzero((a != b) & (np.abs(n[i] - sizes[j]) <= longer * EDITS + 1e-9))
        keep = keep[_few_edits(mine, i[keep], rows, j[keep], np.floor(longer[keep] * EDITS + 1e-9))]
        return pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep]})

    by = ["band", "seg", "block"]
    return copies.groupBy(*by).cogroup(visits.groupBy(*by)).applyInPandas(visit, "a long, b long").distinct()


# ---- tiles of a table ---------------------------------------------------------------------------------------------


def _folded(bags: np.ndarray, width: int) -> np.ndarray:
    """Word counts of fewer classes, from those of more."""
    return bags if bags.shape[1] == width else np.minimum(bags.reshape(len(bags), width, -1).sum(2, dtype=np.int64), 65535).astype(np.uint16)


def _least_common(n: np.ndarray) -> np.ndarray:
    """Words that a text of n words has in common with any shorter one that it may repeat, less what rounding takes; it never falls as n grows."""
    return np.where(n > MOST_WORDS, -1.0, (n - np.floor(n * EDITS + 1e-9)) * (1 - 1e-4)).astype(np.float32)


def match_tile(key: np.ndarray, n: np.ndarray, bags: np.ndarray, of: np.ndarray, m: np.ndarray, rows: np.ndarray, exact: bool = False) -> np.ndarray:
    """(query, row) of all pairs whose row has the smaller key and whose lengths and word counts allow so few edits. No pair is lost.

    The product of the counts' roots is at least the number of common words. ``exact`` does without this bound.
    """
    width = min(bags.shape[1], rows.shape[1])
    i_at, j_at = np.argsort(n, kind="stable"), np.argsort(m, kind="stable")
    key, n, bags, of, m, rows = key[i_at], n[i_at], _folded(bags[i_at], width), of[j_at], m[j_at], _folded(rows[j_at], width)
    q, x = np.sqrt(bags.astype(np.float32)), np.sqrt(rows.astype(np.float32))
    out = [np.empty((0, 2), np.int64)]
    for s in range(0, len(n), STEP):
        mine = n[s : s + STEP]
        first, last = np.searchsorted(m, mine[0] * (1 - EDITS) - 1e-6), np.searchsorted(m, mine[-1] / (1 - EDITS) + 1e-6, "right")
        for t in range(first, last, STEP):
            z = min(t + STEP, last)
            sim = q[s : s + STEP] @ x[t:z].T
            least = _least_common(np.maximum(mine, m[t])) if not exact and m[z - 1] <= MOST_WORDS else np.full(len(mine), -1, np.float32)
            some = np.flatnonzero(sim.max(1) >= least)
            if not len(some):
                continue
            i, j = np.nonzero(sim[some] >= least[some, None])
            i, j = s + some[i], t + j
            longer = np.maximum(n[i], m[j])
            keep = np.flatnonzero((of[j] < key[i]) & (np.abs(n[i] - m[j]) <= longer * EDITS + 1e-9))
            i, j, most = i[keep], j[keep], np.floor(longer[keep] * EDITS + 1e-9)
            keep = _few_edits(bags, i, rows, j, most)
            out.append(np.stack([i_at[i[keep]], j_at[j[keep]]], 1))
    return np.concatenate(out)


def search_tiles(rows: DataFrame, queries: DataFrame, exact: bool = False) -> DataFrame:
    """``a, b``: candidate pairs of a row and a query with a larger key (key, n, bag, as :func:`embed_texts` makes them for tiles).

    Rows lie in strips by length, cut into parts; a query visits the strips that a text with at most one word in ten changed can
    be in. A tile is a part of a strip and a block of its visitors.
    """
    strip = lambda n: F.floor(F.log(n) / F.log(F.lit(STRIP))).cast("int")
    counts = F.sum(F.length("bag") / 2)
    r = rows.select("key", "n", "bag", strip(F.col("n")).alias("strip"))
    q = queries.select(*[F.col(c).alias(c) for c in ("key", "n", "bag")], F.explode(F.sequence(strip(F.col("n") * (1 - EDITS) - 1e-6), strip(F.col("n") / (1 - EDITS) + 1e-6))).alias("strip"))
    parts = r.groupBy("strip").agg(F.ceil(counts / TILE).cast("int").alias("parts"))
    blocks = q.groupBy("strip").agg(F.ceil(counts / TILE).cast("int").alias("blocks"))
    sizes = stage(parts.join(blocks, "strip"), "strips")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    r = r.join(F.broadcast(sizes), "strip").withColumn("part", F.pmod(F.xxhash64("key"), "parts").cast("int")).select("strip", "part", each("blocks").alias("block"), "key", "n", "bag")
    q = q.join(F.broadcast(sizes), "strip").withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int")).select("strip", each("parts").alias("part"), "block", "key", "n", "bag")

    def one_width(g: pd.DataFrame):
        """Keys, lengths and counts of the rows of each width."""
        width = g["bag"].str.len().to_numpy(np.int64) // 2
        for w in np.unique(width):
            x = g[width == w]
            yield x["key"].to_numpy(np.int64), x["n"].to_numpy(np.int64), np.frombuffer(b"".join(x["bag"]), np.uint16).reshape(-1, w)

    def visit(keys, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for of, m, counts in one_width(left) if len(left) and len(right) else ():
            for key, n, bags in one_width(right):
                i, j = match_tile(key, n, bags, of, m, counts, exact).T
                a.append(of[j])
                b.append(key[i])
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    by = ["strip", "part", "block"]
    return r.groupBy(*by).cogroup(q.groupBy(*by)).applyInPandas(visit, "a long, b long").distinct()


def edit_words(a: list, b: list, most: int) -> int:
    """Words to add, remove or replace, exactly (bit-parallel over the shorter text); more than ``most`` gives ``most + 1``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    i = 0
    while i < len(a) and i < len(b) and a[i] == b[i]:
        i += 1
    j = 0
    while j < len(a) - i and j < len(b) - i and a[-1 - j] == b[-1 - j]:
        j += 1
    a, b = a[i : len(a) - j], b[i : len(b) - j]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return min(len(b), most + 1)
    at: dict = {}
    for k, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << k
    full, high = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score, left = full, 0, len(a), len(b)
    for w in b:
        eq = at.get(w, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = (down | ~(xh | up)) & full, up & xh
        score += 1 if ph & high else -1 if mh & high else 0
        left -= 1
        if score - left > most:
            return most + 1
        ph, mh = (ph << 1 | 1) & full, mh << 1 & full
        up, down = (mh | ~(xv | ph)) & full, ph & xv
    return min(score, most + 1)


def rerank(pairs: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``a, b, edits`` of the pairs of which at most one word in ten differs."""
    need = pairs.select(F.col("a").alias("k")).unionAll(pairs.select(F.col("b").alias("k"))).distinct()
    t = stage(docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).where("t IS NOT NULL").join(need, "k", "left_semi"), "texts-to-compare")
    both = pairs.join(t.select(F.col("k").alias("a"), F.col("t").alias("ta")), "a").join(t.select(F.col("k").alias("b"), F.col("t").alias("tb")), "b")

    def run(batches):
        for g in batches:
            out = []
            for a, b, x, y in zip(g["a"], g["b"], g["ta"], g["tb"], strict=True):
                x, y = x.split(), y.split()
                most = int(max(len(x), len(y)) * EDITS + 1e-9)
                e = edit_words(x, y, most)
                if e <= most:
                    out.append((a, b, e))
            yield pd.DataFrame(out, columns=["a", "b", "edits"])

    return both.select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long, edits long")


# ---- the operator -------------------------------------------------------------------------------------------------


def digest(c: Column) -> Column:
    """The hex digits of a stated hash however spelled; null if none is stated."""
    s = F.regexp_replace(F.lower(c), r"[\s ]", "")
    h = F.regexp_extract(s, r"^(?:(?:sha|md|blake)[0-9]*[-_:=/]*(?:256|512|384|1|5)?[-_:=]+|0x)?([0-9a-f]{32,128})$", 1)
    return F.when(h != "", h)


def _first_of(m: DataFrame, new: DataFrame) -> DataFrame:
    """(id, kept) by hash and by address."""
    by_hash = m.where("h IS NOT NULL").groupBy("h").agg(F.min("id").alias("kept"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    one = new.join(by_hash, "h").where("kept < id").select("id", "kept")
    by_url = m.where("u <> ''").groupBy("u").agg(F.min("id").alias("any"), F.min(F.when(F.col("h").isNull(), F.col("id"))).alias("bare"), F.count(F.lit(1)).alias("c")).where("c > 1 AND bare IS NOT NULL").drop("c")
    two = new.join(by_url, "u").select("id", F.when(F.col("h").isNull(), F.col("any")).otherwise(F.col("bare")).alias("kept")).where("kept < id")
    return one.unionAll(two)


def similar_texts(docs: DataFrame, batches: DataFrame, exact: bool = False) -> DataFrame:
    """(id, kept) by text. ``docs``: id, text; ``batches``: id, batch_no of all manifests; texts of other ids are left out.

    Equal texts are one class, matched by its first member; only classes with a member in a later batch search, and only among
    smaller ids.
    """
    d = stage(embed_texts(docs, "id", "text", tiles=True), "texts")
    m = d.select(F.col("key").alias("id"), "same").join(batches, "id")
    cls = m.groupBy("same").agg(F.min("id").alias("first"), F.max("batch_no").alias("newest"))
    rows = d.where("n >= 9").join(cls.select(F.col("first").alias("key"), "same", "newest"), ["key", "same"]).dropDuplicates(["key", "same"])  # nine words can differ from ten by one; of fewer none may differ
    rows = stage(rows.select("key", "n", "bag", "newest"), "vectors")
    pairs = stage(search_tiles(rows, rows.where("newest > 0"), exact), "candidates")
    discard(rows)
    near = rerank(pairs, docs, "id", "text").groupBy(F.col("b").alias("first")).agg(F.min("a").alias("near"))
    best = cls.where("newest > 0").join(near, "first", "left").select("same", F.coalesce("near", "first").alias("kept"))
    return m.where("batch_no > 0").join(best, "same").where("kept < id").select("id", "kept")


def duplicates_of_history(manifests: DataFrame, docs: DataFrame, exact: bool = False) -> DataFrame:
    """``kept_id, manifest_id``: every manifest of a later batch (``batch_no`` > 0) that repeats an earlier one (smaller id),
    with the smallest id it repeats: by stated hash; by page address, where one of the two states no hash; or by text.

    Defined cases: a null batch is history; a null id gives no row; blank or unreadable hashes are not stated; blank
    addresses and texts repeat nothing; texts of fewer than nine words repeat equal ones only; rows repeated with one id are
    one manifest, which may have several texts; empty tables give an empty table; other columns are ignored. ``exact`` compares
    all pairs that their lengths allow without the bound on common words.
    """
    m = manifests.select(
        F.col("manifest_id").cast("long").alias("id"), F.coalesce("batch_no", F.lit(0)).alias("batch_no"), digest(F.col("content_hash")).alias("h"), normalize_url(F.regexp_replace("url", r"^[\s ]+|[\s ]+$", ""), keep_scheme=False).alias("u")
    ).where("id IS NOT NULL")
    m = stage(m, "manifests")
    texts = docs.select(F.col("manifest_id").cast("long").alias("id"), "text").where("id IS NOT NULL AND text IS NOT NULL")
    found = _first_of(m, m.where("batch_no > 0")).unionAll(similar_texts(texts, m.groupBy("id").agg(F.max("batch_no").alias("batch_no")), exact))
    return found.groupBy(F.col("id").alias("manifest_id")).agg(F.min("kept").alias("kept_id")).select("kept_id", "manifest_id")


def first_repeated(pairs: DataFrame) -> DataFrame:
    """``id, kept``: the smallest id that each text repeats, from the pairs of an index; a copy repeats what its first one does."""
    best = pairs.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("kept"))
    return best.join(best.select(F.col("id").alias("kept"), F.col("kept").alias("older")), "kept", "left").join(pairs.where("edits = 0").select(F.col("a").alias("kept"), F.col("b").alias("id"), F.lit(True).alias("copy")).distinct(), ["id", "kept"], "left").select(
        "id", F.when(F.col("copy"), F.least("kept", "older")).otherwise(F.col("kept")).alias("kept")
    )


class HistoryIndex:
    """Index shards on shared storage for batches that arrive one after another: each batch adds its shards, ``compact`` merges small ones.

    ``texts/batch=<no>`` and ``shards/batch=<no>`` hold a batch each, ``compacted/upto=<no>`` the merged shards of all batches up to
    that number. Every folder is written whole and counts once its ``_SUCCESS`` is there; nothing is overwritten that readers
    use, so a failure loses nothing, and a batch that is given again under its number replaces itself.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _done(self, part: str, key: str) -> list[int]:
        """Numbers of the folders ``part/key=<no>`` that are complete."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{key}=") and path_exists(self.spark, f"{self.path}/{part}/{n}/_SUCCESS"))

    def shards(self, before: int | None = None) -> DataFrame | None:
        """Shards of all batches, or of those numbered below ``before``; a compacted folder stands for the batches in it."""
        fits = lambda n: before is None or n < before
        base = max((n for n in self._done("compacted", "upto") if fits(n)), default=-1)
        paths = [f"{self.path}/compacted/upto={base}"] if base >= 0 else []
        paths += [f"{self.path}/shards/batch={n}" for n in self._done("shards", "batch") if n > base and fits(n)]
        return self.spark.read.schema(_SHARD).parquet(*paths) if paths else None

    def add(self, batch: DataFrame, number: int, exact: bool = False) -> DataFrame:
        """``a, b, edits``: what of ``batch`` (id, text), the batch of this number, repeats a text of an earlier one or of its own;
        adds the batch. Only the batch's texts are embedded; of earlier ones, candidates alone are read, and every one's identity.

        Equal texts are matched by identity, not by search: one that was there before, or comes first in the batch, stands for
        them, and only it is indexed and compared; the others repeat it with 0 edits.
        """
        d = stage(batch.select(F.col("id").cast("long").alias("id"), "text").where("id IS NOT NULL AND trim(text) <> ''"), "batch")
        rows = stage(embed_texts(d, "id", "text"), "batch-embedded")
        first = rows.groupBy("same").agg(F.min("key").alias("first"))
        done = [n for n in self._done("texts", "batch") if n < number]
        known = self.spark.read.schema("id long, text string, same binary").parquet(*[f"{self.path}/texts/batch={n}" for n in done]).select("same", F.col("id").alias("known")) if done else None
        first = first.join(known, "same", "left").withColumn("first", F.coalesce("known", "first")) if known is not None else first.withColumn("known", F.lit(None).cast("long"))
        first = stage(first, "batch-firsts")
        equal = rows.join(first, "same").where("key <> first").select(F.col("first").alias("a"), F.col("key").alias("b"), F.lit(0).cast("long").alias("edits")).distinct()
        rows = rows.join(first.where("known IS NULL"), "same").where("key = first").dropDuplicates(["key", "same"]).drop("first", "known").withColumn("band", F.floor(F.log("n") / F.log(F.lit(BAND))).cast("int"))
        size = rows.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).alias("parts"))
        rows = rows.join(size, "band").withColumn("seg", (F.lit(number) * 4096 + F.pmod(F.xxhash64("key"), F.col("parts"))).cast("int")).drop("parts")
        rows = stage(rows, "batch-vectors")
        old = self.shards(number)
        d.join(rows.select(F.col("key").alias("id"), "same"), "id").select("id", "text", "same").write.mode("overwrite").parquet(f"{self.path}/texts/batch={number}")
        build_shards(rows).write.mode("overwrite").parquet(f"{self.path}/shards/batch={number}")
        new = self.spark.read.schema(_SHARD).parquet(f"{self.path}/shards/batch={number}")
        pairs = stage(search_shards(rows, new if old is None else old.unionByName(new), exact), "batch-candidates")
        texts = self.spark.read.schema(d.schema).parquet(*[f"{self.path}/texts/batch={n}" for n in [*done, number]])
        return rerank(pairs, texts, "id", "text").unionByName(equal)

    def compact(self) -> int:
        """Merges, band by band, shards that together fit one, into a new folder; returns the number of shards left."""
        from pyspark.sql import Window

        upto = max(self._done("shards", "batch"), default=None)
        if upto is None:
            return 0
        s = self.shards()
        size = (F.length("ids") / 8).cast("long")
        s = s.withColumn("into", F.floor((F.sum(size).over(Window.partitionBy("band").orderBy("seg")) - 1) / SHARD_ROWS).cast("int"))

        def unpack(batches):
            for b in batches:
                for r in b.itertuples():
                    ids = np.frombuffer(r.ids, np.int64)
                    w = 2 * DIMS
                    bags = [bytes(r.bags)[i * w : i * w + w] for i in range(len(ids))]
                    yield pd.DataFrame({"band": np.int32(r.band), "seg": np.int32(r.into), "key": ids, "n": np.frombuffer(r.sizes, np.int64), "bag": bags})

        rows = s.select("band", "into", "ids", "sizes", "bags").mapInPandas(unpack, "band int, seg int, key long, n long, bag binary")
        build_shards(rows).write.mode("overwrite").parquet(f"{self.path}/compacted/upto={upto}")
        return self.shards().count()
