"""Evaluation texts leaking into training text.

The n-grams of the held-out passages go to every task as one hash set; a training text is tokenised once, its words become
numbers of the passages' own vocabulary (0 for every other word), and only windows without a 0 are looked up. Hits are
compared as exact word sequences.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N = 8
#: Passages of at most so many characters go to the tasks at once; more are scanned for in blocks of that size.
BLOCK_CHARS = 16 << 20
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> str:
    """Lower case of the same length, so positions hold: U+0130 is the one character whose lower case is longer."""
    return text.replace("\u0130", "i").lower()


def words(text: str) -> list[str]:
    return _WORD.findall(fold(text))


class PassageIndex:
    """n-grams of passages: vocabulary, grams and passage lengths."""

    def __init__(self, items: list[tuple[int, str]], n: int = N):
        self.n, self.vocab, self.grams, self.sizes = n, {}, {}, {}
        for item, passage in items:
            ids = tuple(self.vocab.setdefault(w, len(self.vocab) + 1) for w in words(passage or ""))
            self.sizes[item] = len(ids)
            for i in range(len(ids) - n + 1):
                self.grams.setdefault(ids[i : i + n], []).append((item, i))

    def hits(self, ws: list[str]) -> list[tuple[int, list[tuple[int, int]]]]:
        """(window start, [(item, passage position)]) of the text's words."""
        n, get = self.n, self.vocab.get
        if len(ws) < n:
            return []
        ids = [get(w, 0) for w in ws]
        known = np.cumsum(np.array(ids, dtype=bool), dtype=np.int32)
        full = known[n - 1 :] - np.concatenate((np.zeros(1, np.int32), known[: -n])) == n
        out = []
        for i in np.flatnonzero(full):
            g = self.grams.get(tuple(ids[i : i + n]))
            if g:
                out.append((int(i), g))
        return out

    def leaked(self, ws: list[str], share: float) -> list[int]:
        seen: dict[int, set] = {}
        for _, g in self.hits(ws):
            for item, p in g:
                seen.setdefault(item, set()).update(range(p, p + self.n))
        return sorted(i for i, s in seen.items() if len(s) >= share * self.sizes[i])


def _blocks(items: DataFrame, item_id: str, passage: str) -> list[list[tuple[int, str]]]:
    """The held-out set, in blocks of a bounded size."""
    out: list[list] = [[]]
    size = 0
    for r in items.select(F.col(f"`{item_id}`").cast("long"), F.col(f"`{passage}`")).where(F.col(f"`{passage}`").isNotNull() & F.col(f"`{item_id}`").isNotNull()).distinct().toLocalIterator():
        if size > BLOCK_CHARS:
            out.append([])
            size = 0
        out[-1].append((r[0], r[1]))
        size += len(r[1])
    return out


def find_leaks(docs: DataFrame, items: DataFrame, share: float = 0.5, n: int = N, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage") -> DataFrame:
    """``doc_id, item_id``: documents with at least ``share`` of an item's words in runs of ``n`` or more words that the text also has.

    Defined cases: null or wordless texts and passages leak nothing, nor do passages of fewer than ``n`` words; an item given
    on several rows is judged by each passage; repeated documents give repeated rows; empty tables give an empty table;
    whole texts of any length are read; other columns are ignored.
    """
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    out = None
    for block in _blocks(items, item_id, passage):
        shared = docs.sparkSession.sparkContext.broadcast((block, n))

        def scan(batches, shared=shared):
            rows, n = shared.value
            keyed = PassageIndex([(k, p) for k, (_, p) in enumerate(rows)], n)
            for b in batches:
                found = [(d, rows[k][0]) for d, t in zip(b["doc_id"], b["t"], strict=True) for k in keyed.leaked(words(t), share)]
                found = list(dict.fromkeys(found)) if len({r[0] for r in rows}) < len(rows) else found
                yield pd.DataFrame(found, columns=["doc_id", "item_id"]).astype("int64")

        x = d.mapInPandas(scan, "doc_id long, item_id long")
        out = x if out is None else out.unionAll(x)
    return out


def remove_leaks(docs: DataFrame, items: DataFrame, n: int = N, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage", mark: str = " ") -> DataFrame:
    """``doc_id, text, removed``: every document, with each run of ``n`` or more words of any passage replaced by ``mark``.

    ``removed`` counts the characters cut. Runs that overlap are cut as one. Documents without such
    runs come back unchanged; a null text stays null; repeated documents give repeated rows. The held-out set is scanned in
    blocks one after the other, so spans of all blocks go.
    """
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.lit(0).cast("long").alias("removed"))
    for block in _blocks(items, item_id, passage):
        shared = docs.sparkSession.sparkContext.broadcast((block, n))

        def cut(batches, shared=shared):
            rows, n = shared.value
            index = PassageIndex(rows, n)
            for b in batches:
                texts, gone = b["text"].tolist(), b["removed"].tolist()
                for i, t in enumerate(texts):
                    hits = index.hits(words(t)) if t else []
                    if not hits:
                        continue
                    at = [m.span() for m in _WORD.finditer(fold(t))]
                    parts, last = [], 0
                    for s, _ in hits:
                        a, z = at[s][0], at[s + n - 1][1]
                        if a > last or not parts:
                            parts += [t[last:a], mark]
                        gone[i] += z - max(a, last)
                        last = z
                    texts[i] = "".join(parts) + t[last:]
                b = b.copy()
                b["text"], b["removed"] = texts, gone
                yield b

        d = d.mapInPandas(cut, "doc_id long, text string, removed long")
    return d
