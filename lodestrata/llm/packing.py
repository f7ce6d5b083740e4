"""Filling fixed-capacity containers with texts measured in tokens.

Only the histogram of lengths is planned, and it has at most as many entries as the capacity: shallow combinations of
length bins that fill a container up to its last bin are enumerated, non-negative least squares gives how often each is
repeated, the counts are rounded up in falling order while the histogram's residual has the items, and what remains is packed
greedily, longest first. The plan is a list of runs (so many containers alike); every item finds its container from its rank
among the items of its length.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Length bins of a capacity (every length has its own where there are no more), and gradient steps of the solver.
BINS, STEPS = 2048, 400
#: The solver ends where a step moves less than this part of all repeats.
SETTLED = 1e-3
#: Repeats of a combination that least squares must see for it to be taken.
LEAST = 0.05
#: Items of one length that a task ranks.
PART_ROWS = 100_000


def load_tokenizer(path: str | bytes = TOKENIZER):
    """An encoding from a public vocabulary file (.tiktoken ranks), or from what is in it."""
    import base64
    from pathlib import Path

    import tiktoken

    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in (path if isinstance(path, bytes) else Path(path).read_bytes()).splitlines() if x)}
    return tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, tokens``: whole texts in tokens; null and empty texts have none and give no row. The driver reads the vocabulary
    file (a few MB) and sends it to the tasks."""
    from pathlib import Path

    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t")).where("t <> '' AND doc_id IS NOT NULL")

    def run(batches):
        enc = load_tokenizer(shared.value)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "tokens": [len(enc.encode_ordinary(t)) for t in b["t"]]})

    return d.mapInPandas(run, "doc_id long, tokens long")


def nnls(idx: np.ndarray, b: np.ndarray, weight: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 that minimises the weighted |a x - b|, by accelerated projected gradients.

    Column j of ``a`` counts the rows in ``idx[j]``; the row len(b) pads.
    """
    n = len(b)
    b, w = np.append(b * weight, 0.0), np.append(weight, 0.0)
    flat, depth = idx.ravel(), idx.shape[1]
    times = lambda x: np.bincount(flat, np.repeat(x, depth), n + 1) * w
    back = lambda r: (r * w)[idx].sum(1)
    v, lip = np.ones(len(idx)), 1.0
    for _ in range(30):  # largest eigenvalue by power iteration
        u = back(times(v))
        lip = max(np.linalg.norm(u), 1e-12)
        v = u / lip
    lip *= 1.02
    x = y = np.zeros(len(idx))
    t = 1.0
    for _ in range(steps):
        nx = np.maximum(0, y - back(times(y) - b) / lip)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = nx + (t - 1) / nt * (nx - x)
        moved = np.abs(nx - x).sum()
        x, t = nx, nt
        if moved <= SETTLED * x.sum():
            break
    return x


def combinations(total: int, present: np.ndarray) -> np.ndarray:
    """Multisets of at most three of the bins ``present`` (ascending) that fill ``total`` bins, one a row; -1 pads."""
    on = np.zeros(total + 1, bool)
    on[present[present <= total]] = True
    have = present[present <= total]
    out = [np.array([[total, -1, -1]])] if on[total] else []
    i = have[2 * have <= total]
    i = i[on[total - i]]
    out.append(np.stack([i, total - i, np.full(len(i), -1)], 1))
    for a in have[3 * have <= total].tolist():
        j = have[(have >= a) & (2 * have <= total - a)]
        j = j[on[total - a - j]]
        out.append(np.stack([np.full(len(j), a), j, total - a - j], 1))
    return np.concatenate(out).astype(np.int64)


class _Plan:
    """Runs over a histogram: (length, items a container, containers, first container)."""

    def __init__(self, capacity: int, hist: dict[int, int]):
        self.cap, self.left, self.mask = capacity, dict(hist), 0
        for n in hist:
            self.mask |= 1 << n
        self.runs: list[tuple[int, int, int, int]] = []
        self.containers = 0

    def take(self, n: int, k: int) -> None:
        self.left[n] -= k
        if not self.left[n]:
            self.mask ^= 1 << n

    def longest(self, room: int) -> int:
        return (self.mask & ((1 << (room + 1)) - 1)).bit_length() - 1 if room > 0 else -1

    def close(self, got: list[tuple[int, int]], room: int, k: int) -> None:
        """Fills k containers that hold ``got`` (length, items each) greedily and lays them down."""
        todo = [(got, room, k)]
        while todo:
            got, room, k = todo.pop()
            while (n := self.longest(room)) > 0:
                t = room // n
                full = min(k, self.left[n] // t)
                if not full:  # fewer than one container takes: the first one gets them
                    t, full = self.left[n], 1
                if full < k:
                    todo.append((got, room, k - full))
                    k = full
                self.take(n, t * full)
                got, room = [*got, (n, t)], room - n * t
            for n, t in got:
                self.runs.append((n, t, k, self.containers))
            self.containers += k


def plan(capacity: int, hist: dict[int, int], use_nnls: bool = True) -> tuple[list[tuple[int, int, int, int]], int]:
    """(runs, containers) for lengths 1..capacity with their counts. Bounded by the capacity, whatever the counts.

    ``use_nnls=False`` packs greedily throughout, to measure what the combinations gain.
    """
    p = _Plan(capacity, {n: c for n, c in hist.items() if c})
    step = capacity / min(BINS, capacity)
    bins = round(capacity / step)
    of = lambda n: int(np.ceil(n / step - 1e-9))
    by: dict[int, list[int]] = {}
    for n in sorted(p.left):
        by.setdefault(of(n), []).append(n)
    count = np.zeros(bins + 1)
    for b, ns in by.items():
        count[b] = sum(p.left[n] for n in ns)
    combos = combinations(bins, np.flatnonzero(count)) if use_nnls else np.empty((0, 3), np.int64)
    if len(combos):
        used = np.unique(combos[combos >= 0])
        row = np.full(bins + 2, len(used))
        row[used] = np.arange(len(used))
        scale = max(count.max(), 1)
        # the longer an item, the more it matters that it is placed
        x = nnls(row[combos], count[used] / scale, np.sqrt(used / bins)) * scale
        order = np.argsort(-x, kind="stable")
        for j in order[: np.count_nonzero(x >= LEAST)].tolist():
            need = Counter(c for c in combos[j].tolist() if c >= 0)
            k = min(int(np.ceil(x[j] - 1e-6)), *(int(count[b]) // t for b, t in need.items()))
            for b, t in need.items():
                count[b] -= k * t
            while k > 0:
                items: dict[int, int] = {}
                for b in need.elements():  # the longest lengths left of each bin
                    n = next((n for n in reversed(by[b]) if p.left[n] - items.get(n, 0) > 0), 0)
                    if not n:  # filled up with others before
                        items = {}
                        break
                    items[n] = items.get(n, 0) + 1
                if not items:
                    break
                m = min([k, *(p.left[n] // t for n, t in items.items())])
                for n, t in items.items():
                    p.take(n, t * m)
                p.close(list(items.items()), capacity - sum(n * t for n, t in items.items()), m)
                k -= m
    while p.mask:
        n = p.mask.bit_length() - 1
        t = min(capacity // n, p.left[n])
        k = p.left[n] // t
        p.take(n, t * k)
        p.close([(n, t)], capacity - n * t, k)
    return p.runs, p.containers


def pack(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """``target_id, container_id, doc_id, piece_no, start_token, end_token``: every text's container, for each capacity.

    ``sizes``: doc_id, tokens. ``targets``: target_id, capacity_tokens (a handful of rows, read by the driver). Only a text
    longer than the capacity is cut, into whole containers and a rest. Containers of a target are numbered from 0.

    Defined cases: texts without tokens and targets without a positive capacity give no rows; repeated rows are separate
    items; ties are laid by document and piece; an empty table gives an empty table. The driver holds one histogram a
    target (at most as many entries as the capacity) and its runs; items of one length are ranked in parts.
    """
    spark = sizes.sparkSession
    caps = {int(r.target_id): int(r.cap) for r in targets.where("target_id IS NOT NULL AND capacity_tokens > 0").select("target_id", F.col("capacity_tokens").alias("cap")).collect()}
    each = F.array(*[F.struct(F.lit(t).alias("target_id"), F.lit(c).cast("long").alias("cap")) for t, c in sorted(caps.items())]) if caps else F.array().cast("array<struct<target_id:int,cap:bigint>>")
    items = sizes.where("tokens > 0").select("doc_id", "tokens", F.explode(each).alias("t")).select("doc_id", "tokens", "t.*")
    items = items.select("target_id", "cap", "doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(tokens - 1) div cap"))).alias("piece_no"))
    items = items.select("target_id", "doc_id", "piece_no", (F.col("piece_no") * F.col("cap")).alias("start_token"), F.least("tokens", (F.col("piece_no") + 1) * F.col("cap")).alias("end_token"))
    items = items.withColumn("size", F.col("end_token") - F.col("start_token"))
    lengths = stage(items.groupBy("target_id", "size").agg(F.count(F.lit(1)).alias("n")), "pack-lengths")
    hist: dict[int, dict[int, int]] = {t: {} for t in caps}
    for r in lengths.collect():
        hist[r.target_id][int(r["size"])] = int(r.n)
    # a length that many items have is ranked in as many parts as it needs
    items = items.join(lengths, ["target_id", "size"]).withColumn("part", F.pmod(F.xxhash64("doc_id", "piece_no"), F.ceil(F.col("n") / PART_ROWS))).drop("n")
    counts = stage(items.groupBy("target_id", "size", "part").count(), "pack-counts")
    laid: dict[tuple[int, int], list] = {}
    for t, h in hist.items():
        at: dict[int, int] = {}
        for n, per, k, first in plan(caps[t], h)[0]:
            laid.setdefault((t, n), []).append((at.get(n, 0), per, first))
            at[n] = at.get(n, 0) + per * k
    arrays = {key: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for key, v in laid.items()}
    shared = spark.sparkContext.broadcast(arrays)
    before = counts.select("target_id", "size", "part", (F.sum("count").over(Window.partitionBy("target_id", "size").orderBy("part")) - F.col("count")).alias("before"))
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("target_id", "size", "part").orderBy("doc_id", "piece_no"))).join(before, ["target_id", "size", "part"])
    ranked = ranked.select("target_id", "size", (F.col("before") + F.col("rank") - 1).alias("slot"), "doc_id", "piece_no", "start_token", "end_token")

    def place(batches):
        runs = shared.value
        for b in batches:
            out = np.empty(len(b), np.int64)
            t, n, slot = b["target_id"].to_numpy(), b["size"].to_numpy(), b["slot"].to_numpy(np.int64)
            key = t.astype(np.int64) << 40 | n.astype(np.int64)
            order = np.argsort(key, kind="stable")
            for g in np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(b) else []:
                start, per, first = runs[int(t[g[0]]), int(n[g[0]])]
                i = np.searchsorted(start, slot[g], side="right") - 1
                out[g] = first[i] + (slot[g] - start[i]) // per[i]
            yield pd.DataFrame({"target_id": t.astype(np.int32), "container_id": out, "doc_id": b["doc_id"], "piece_no": b["piece_no"], "start_token": b["start_token"], "end_token": b["end_token"]})

    return ranked.mapInPandas(place, "target_id int, container_id long, doc_id long, piece_no long, start_token long, end_token long")
