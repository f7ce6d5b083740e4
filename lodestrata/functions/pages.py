"""Marked-up pages: title, meta tags, links, structured content, main text; long texts in chunks."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DROP = {"script", "style", "nav", "footer", "header", "aside", "iframe", "noscript", "form", "head"}
_VOID = {"br", "hr", "img", "input", "link", "meta", "area", "base", "col", "embed", "source", "track", "wbr"}


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.metas, self.links, self.text, self.skip, self.in_title = "", [], [], [], [], False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "title":
            self.in_title = True
        elif tag == "meta" and (a.get("property") or a.get("name")) and "content" in a:
            self.metas.append(((a.get("property") or a["name"]).lower(), a["content"]))
        elif tag == "a" and a.get("href"):
            self.links.append(a["href"])
        hidden = "display:none" in a.get("style", "").replace(" ", "").lower()
        if tag not in _VOID and (tag in _DROP or hidden or self.skip):
            self.skip.append(tag)

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag in self.skip:
            while self.skip and self.skip.pop() != tag:
                pass

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.skip and data.strip():
            self.text.append(" ".join(data.split()))


def read_page(payload: str) -> tuple[str, list[tuple[str, str]], list[str], str]:
    r = _Reader()
    r.feed(payload)
    r.close()
    return " ".join(r.title.split()), r.metas, r.links, "\n".join(r.text)


def page_parts(pages: DataFrame, key: str, payload: str) -> DataFrame:
    """``key, title, metas, links, main_text`` of every page, in one parse; a null payload gives nulls."""
    d = pages.select(F.col(f"`{key}`").alias("k"), F.col(f"`{payload}`").alias("p"))
    kind = d.schema["k"].dataType.simpleString()

    def run(batches):
        for b in batches:
            rows = [(k, *((None, None, None, None) if p is None else read_page(p))) for k, p in zip(b["k"], b["p"], strict=True)]
            yield pd.DataFrame([(k, t, None if m is None else [{"name": n, "content": c} for n, c in m], a, x) for k, t, m, a, x in rows], columns=["k", "title", "metas", "links", "main_text"])

    out = d.mapInPandas(run, f"k {kind}, title string, metas array<struct<name string, content string>>, links array<string>, main_text string")
    return out.withColumnRenamed("k", key)


def has_structured_content(c: Column) -> Column:
    return c.rlike(r"(?i)<(table|dl|ol|ul)\b|itemtype\s*=")


def chunk_column(c: Column, max_tokens: int = 3000, overlap_tokens: int = 100) -> Column:
    """array<struct<text, token_count>>: paragraphs packed greedily, each chunk but the first led by the end of the one before.

    A fold over the paragraphs, all in the JVM. A text that fits is one chunk; a longer paragraph is not split; an empty
    text has no chunk.
    """
    tok = lambda x: F.greatest(F.lit(1), F.floor(F.length(x) / 4)).cast("int")
    cell = "array<struct<text:string,token_count:int>>"
    zero = F.struct(F.array().cast(cell).alias("done"), F.lit("").alias("cur"), F.lit(0).alias("n"))

    def step(a, p):
        n = tok(p)
        over = (a["n"] + n > max_tokens) & (a["cur"] != "")
        head = F.when(F.length(a["cur"]) > overlap_tokens * 4, F.substring(a["cur"], -overlap_tokens * 4, overlap_tokens * 4)).otherwise(a["cur"]) if overlap_tokens else F.lit("")
        led = F.concat(head, F.lit("\n\n"), p)
        closed = F.concat(a["done"], F.array(F.struct(F.trim(a["cur"]).alias("text"), a["n"].alias("token_count"))))
        grown = F.when(a["cur"] == "", p).otherwise(F.concat(a["cur"], F.lit("\n\n"), p))
        return F.when(over, F.struct(closed.alias("done"), led.alias("cur"), tok(led).alias("n"))).otherwise(F.struct(a["done"].alias("done"), grown.alias("cur"), (a["n"] + n).alias("n")))

    folded = F.aggregate(F.split(c, r"\n\n+"), zero, step, lambda a: F.when(F.trim(a["cur"]) == "", a["done"]).otherwise(F.concat(a["done"], F.array(F.struct(F.trim(a["cur"]).alias("text"), a["n"].alias("token_count"))))))
    one = F.array(F.struct(c.alias("text"), tok(c).alias("token_count")))
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast(cell)).when(tok(c) <= max_tokens, one).otherwise(folded)


def chunk_texts(df: DataFrame, key: str, text: str, max_tokens: int = 3000, overlap_tokens: int = 100) -> DataFrame:
    """``key, chunk_index, text, token_count, total_chunks``."""
    d = df.select(f"`{key}`", chunk_column(F.col(f"`{text}`"), max_tokens, overlap_tokens).alias("c"))
    return d.select(f"`{key}`", F.size("c").alias("total_chunks"), F.posexplode("c").alias("chunk_index", "x")).select(f"`{key}`", "chunk_index", "x.text", "x.token_count", "total_chunks")
