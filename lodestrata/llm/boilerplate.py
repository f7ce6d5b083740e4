"""Main content of pages by nearest-URL page differencing.

Pages are put in order of their URL paths inside each host; every page is aligned, line by line, with the pages of the three
nearest paths on both sides by a longest common subsequence, and lines that other articles share are marked. Shared lines go
by kind: the lines of one class of a site (where there is no class, of one tag on all sites) go if most of them are shared, so
a subheading that several articles happen to have stays with the unshared ones of its class, and a promotion goes where no
neighbour has it.
Pages already reduced to text have no classes; of them the lines go that marked-up pages show to be furniture, or neighbours share.

Payloads are read once and never moved: what is aligned are 64-bit numbers of lines. Pages are worked on in blocks of a fixed
number of pages; the neighbours that lie in other blocks are copied to them, so neither blocks nor partitions change the result.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, stage

#: Paths on each side of a page's own that it is aligned with; pages of a block.
REACH, BLOCK = 3, 512
#: In lines of at most so many characters numbers do not count ("9 min read").
SHORT = 20
#: Pages that share more than this part of the smaller one's text, a line of at least ``BODY`` characters included, are one article.
COPY, BODY = 0.6, 160
#: A site's class is judged by its lines and by as many lines of what is usual for its tags on all sites.
PRIOR = 4.0
#: Most characters of a menu's entry and of a whole menu on one line.
ENTRY, MENU = 20, 200
_TAG = re.compile(r"\s*<([a-zA-Z][\w:-]*)((?:\s[^>]*)?)>")
_CLASS = re.compile(r"class\s*=\s*[\"']([^\"']*)[\"']", re.I)
_ANY = re.compile(r"<[^>]*>")
_BLOCK = re.compile(r"<(/?)(nav|aside|footer|header|form|head|script|style|noscript|iframe)\b", re.I)
_LINK = re.compile(r"\s*(?:<li[^>]*>\s*)?<a\b[^>]*>.*</a>\s*(?:</li>)?\s*\Z", re.I | re.S)
_ROW = re.compile(r"(?:\s[>|·•›»/]\s.*){2,}")
_END = re.compile(r"(?<!\b[^\W\d_])(?<!\bM[rs])(?<!\bDr)(?<!\bMrs)(?<!\bProf)(?<!\bLtd)[.!?][\"'”’)]*\s+[\"'“‘(]*[^\W\da-z_]")
_STOP = ".!?…\"”“»"
_MARK = re.compile(r"\s*(?:[-*•·–]|\d+[.)])\s")
_MARKED = re.compile(r"<(?:html|body|head|article|div|p)\b", re.I)
_TITLE = re.compile(r"<title|<head\b", re.I)
_HIDDEN = frozenset(("head", "script", "style", "noscript", "iframe"))


# Flags of a line.
BLOCK_, LINK, MORE, CLASSED, LISTED, ROW, ONE, STOP, CUT, LONG = (1 << k for k in range(10))


def read_lines(payload: str) -> tuple[bool, list[tuple]]:
    """Whether the payload is marked up, and (line number, tag, class, flags, visible text) of the lines with text.

    A line without a tag of its own goes on with the line before it (flag ``MORE``) and has its tag and class.
    """
    marked = _MARKED.search(payload) is not None
    out, depth, hidden = [], 0, 0
    if not marked:
        return False, [(n, "", "", 0, v) for n, line in enumerate(payload.split("\n"), 1) if (v := line.strip())]
    tag = cls = ""
    flags = 0
    for n, line in enumerate(payload.split("\n"), 1):
        at = depth, hidden
        for close, name in _BLOCK.findall(line) if "<" in line else ():
            step = -1 if close else 1
            if name.lower() in _HIDDEN:
                hidden = max(0, hidden + step)
            else:
                depth = max(0, depth + step)
        if at[1] or hidden or "<" in line and _TITLE.search(line):
            continue
        v = html.unescape(_ANY.sub(" ", line)).strip() if "<" in line or "&" in line else line.strip()
        if not v or line.lstrip().startswith(("<!", "<?")):
            continue
        if m := _TAG.match(line):
            c = _CLASS.search(m[2])
            tag, cls = m[1].lower(), c[1].strip() if c else ""
            flags = (BLOCK_ if at[0] or depth else 0) | (LINK if _LINK.match(line) else 0) | (CLASSED if cls else 0)
            out.append((n, tag, cls, flags, v))
        else:
            out.append((n, tag, cls, flags | MORE, v))
    return True, out


def norm(v: str) -> str:
    """A line as it is compared."""
    v = " ".join(v.split()).casefold()
    return re.sub(r"\d+", "0", v) if len(v) <= SHORT else v


def _is_row(v: str) -> bool:
    """A menu on one line: several short entries apart from each other by blanks or marks."""
    if len(v) >= MENU:
        return False
    parts = re.split(r"\s{2,}|\t", v)
    return bool(_ROW.search(v)) or len(parts) > 2 and max(map(len, parts)) <= ENTRY


def _traits(v: str) -> int:
    """Flags of a line of a page that is plain text."""
    return (
        (LISTED if _MARK.match(v) else 0) | (ROW if _is_row(v) else 0) | (0 if _END.search(v) else ONE)
        | (STOP if v[-1] in _STOP else 0) | (CUT if v.endswith(("…", "...")) else 0) | (LONG if len(v) > ENTRY + 4 else 0)
    )


def common(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Pairs of positions of one longest common subsequence of ``a`` and ``b``, bit-parallel over ``b``, equal ends apart."""
    n, m = len(a), len(b)
    i = 0
    while i < n and i < m and a[i] == b[i]:
        i += 1
    k = 0
    while k < n - i and k < m - i and a[n - 1 - k] == b[m - 1 - k]:
        k += 1
    out = [(x, x) for x in range(i)]
    at: dict[int, int] = {}
    for j in range(i, m - k):
        at[b[j]] = at.get(b[j], 0) | 1 << (j - i)
    full = (1 << (m - k - i)) - 1
    v, rows = full, []
    for x in a[i : n - k] if full else ():
        rows.append(v)
        u = v & at.get(x, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    # a zero bit j of v means: b[: j + 1] gives one more match than b[: j]
    mid, j = [], m - k - i - 1
    for x in range(len(rows) - 1, -1, -1):
        while j >= 0 and v >> j & 1:
            j -= 1
        if j < 0:
            break
        if rows[x] >> j & 1:  # this row made the step at j
            mid.append((i + x, i + j))
            j -= 1
        v = rows[x]
    return out + mid[::-1] + [(n - x, m - x) for x in range(k, 0, -1)]


_SIGNS = "page_id long, host string, path string, body long, marked boolean, n array<int>, h array<long>, kind array<long>, tag array<int>, flags array<int>, size array<int>"


def signatures(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """One row a page: numbers of its lines' texts (``h``), of their class or tag (``kind``) and of what tag it is on any site (``tag``)."""
    d = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"), F.col(f"`{payload}`").alias("payload")).where("page_id IS NOT NULL AND payload IS NOT NULL")
    rest = F.regexp_replace("url", r"^[a-zA-Z][\w+.-]*://", "")
    d = d.withColumn("host", F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), r"^www\.|:\d+$", ""))
    d = d.withColumn("path", F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*(.*)$", 1), r"#.*$|[?&](?:utm_\w+|fbclid|gclid|ref|source)=[^&#]*", ""), r"/$", ""))

    def run(batches):
        from xxhash import xxh3_64_intdigest as number

        names = [c.split()[0] for c in _SIGNS.split(", ")]
        for b in batches:
            rows = []
            for pid, host, path, text in zip(b["page_id"], b["host"], b["path"], b["payload"], strict=True):
                marked, lines = read_lines(text)
                h = [number(norm(x[4])) - (1 << 63) for x in lines]
                if marked:
                    kind = [number(f"c {c}" if c else f"t {t} {f & ~MORE}") - (1 << 63) for _, t, c, f, _ in lines]
                    tag = [number(f"{t} {f & ~MORE}") & 0x7FFFFFFF for _, t, _, f, _ in lines]
                    flags = [x[3] for x in lines]
                else:
                    kind, tag, flags = [0] * len(lines), [0] * len(lines), [_traits(x[4]) for x in lines]
                body = number("\n".join(x[4] for x in lines)) - (1 << 63)
                rows.append((pid, host, path, body, marked, [x[0] for x in lines], h, kind, tag, flags, [len(x[4]) for x in lines]))
            yield pd.DataFrame(rows, columns=names)

    return d.select("page_id", "host", "path", "payload").mapInPandas(run, _SIGNS)


def _in_order(signs: DataFrame) -> DataFrame:
    """``signs`` with ``g``, the place of each page among all in order of host, path and id, counted from 0 without gaps."""
    by = ["host", "path", "page_id", "body"]
    r = stage(signs.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()), "pages-in-order")
    discard(signs)
    return _numbered(r, "at", 33, "g")


def _numbered(r: DataFrame, at: str, shift: int, name: str) -> DataFrame:
    """``at``, whose high bits number parts in order and whose low bits are places in them, as one number without gaps.

    The driver sees one row a part.
    """
    part = F.shiftright(F.col(at), shift)
    first, total = [], 0
    for x in r.groupBy(part.alias("part")).count().orderBy("part").collect():
        first.append((x["part"], total))
        total += x["count"]
    o = r.sparkSession.createDataFrame(first or [(0, 0)], "part long, first long")
    return r.withColumn("part", part).join(F.broadcast(o), "part").withColumn(name, F.col("first") + F.col(at).bitwiseAND((1 << shift) - 1)).drop("part", "first")


def _neighbours(r: DataFrame) -> DataFrame:
    """(g, block): first pages of paths (``g``) that a block needs besides its own: those of the ``REACH`` nearest paths, and of
    a path that began in a block before."""
    from pyspark.sql import Window

    reps = r.groupBy("host", "path").agg(F.min("g").alias("g"), F.max("g").alias("z"))
    shift = 16
    reps = reps.withColumn("in", F.row_number().over(Window.partitionBy(F.shiftright("g", shift)).orderBy("g")) - 1)
    reps = stage(reps.select("host", "g", "z", (F.shiftright("g", shift) * (1 << shift) + F.col("in")).alias("at")), "paths-in-order")
    q = _numbered(reps, "at", shift, "k").select("host", "g", "k", F.floor(F.col("g") / BLOCK).alias("lo"), F.floor(F.col("z") / BLOCK).alias("hi"))
    near = q.select("host", "g", F.col("lo").alias("home"), F.explode(F.sequence(F.col("k") - REACH, F.col("k") + REACH)).alias("k"))
    near = near.join(q.select("k", F.col("host").alias("their"), "lo", "hi"), "k").where("host = their AND NOT (lo = home AND hi = home)")
    return near.select("g", "home", F.explode(F.sequence("lo", "hi")).alias("block")).where("block <> home").select("g", "block").distinct()


def _marks(p: dict, q: dict) -> list[tuple[int, int]]:
    """What two pages share; nothing, if they are one article fetched twice."""
    both = common(p["h"], q["h"])
    mine = sum(p["size"][i] for i, _ in both if not p["flags"][i] & LINK)
    least = min(p["text"], q["text"])
    if mine > COPY * max(1, least) and any(p["size"][i] > BODY for i, _ in both):
        return []
    return both


_ALIGNED = "page_id long, g long, host string, marked boolean, n array<int>, h array<long>, kind array<long>, tag array<int>, flags array<int>, votes array<int>"


def aligned(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "payload") -> DataFrame:
    """The pages' lines, and by how many of the nearest paths' pages each is shared (``votes``)."""
    signs = stage(signatures(pages, page_id, url, payload), "page-lines")
    r = _in_order(signs)
    block = F.floor(F.col("g") / BLOCK)
    other = r.join(_neighbours(r), "g").withColumn("own", F.lit(False))
    blocks = r.withColumn("block", block).withColumn("own", F.lit(True)).unionByName(other).drop("at", "body")

    def align(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("g")
        rows = []
        for x in b.to_dict("records"):
            h, size, flags = x["h"].tolist(), x["size"].tolist(), x["flags"].tolist()
            rows.append(x | {"h": h, "size": size, "flags": flags, "text": sum(s for s, f in zip(size, flags, strict=True) if not f & LINK), "votes": [0] * len(h)})
        paths, at = [], []  # first page of each path, and the path of each page
        for x in rows:
            if not paths or (paths[-1]["host"], paths[-1]["path"]) != (x["host"], x["path"]):
                paths.append(x)
            at.append(len(paths) - 1)
        for x, t in zip(rows, at, strict=True):
            first = paths[t] is x
            for k in range(max(0, t - REACH), min(len(paths), t + REACH + 1)):
                y = paths[k]
                if k == t or y["host"] != x["host"] or not (x["own"] or first and y["own"]) or first and k < t:
                    continue  # two first pages meet once
                low, high = (x, y) if t < k else (y, x)
                for i, j in _marks(low, high):
                    if first:
                        low["votes"][i] += 1
                        high["votes"][j] += 1
                    else:
                        x["votes"][i if x is low else j] += 1
        out = pd.DataFrame([x for x in rows if x["own"]], columns=[c.split()[0] for c in _ALIGNED.split(", ")])
        return out

    return stage(blocks.groupBy("block").applyInPandas(align, _ALIGNED), "pages-aligned")


def _choose(flags: list[int], votes: list[int], furniture: list) -> list[int]:
    """Places of a plain text's article lines; ``furniture``: True, False or None (not known from marked-up pages)."""
    # of a text that no marked-up page has, two neighbours must say so; list items are often alike
    bad = [bool(f & ROW or (known if known is not None else v > 1 and not f & LISTED)) for f, v, known in zip(flags, votes, furniture, strict=True)]
    end = len(bad)
    while end and bad[end - 1]:
        end -= 1
    last = max((i for i in range(end) if bad[i]), default=-1)
    tail = range(last + 1, end)
    # announcements of other articles: a furniture heading, then single sentences up to the page's foot
    single = all(flags[i] & ONE for i in tail)
    if tail and last >= 0 and single and all(flags[i] & (STOP | CUT) and flags[i] & LONG and not flags[i] & LISTED for i in tail) and (len(tail) > 1 or flags[tail[0]] & CUT):
        end = last
    elif last >= 0 and single and (k := next((i for i in tail if flags[i] & CUT), None)) is not None:
        end = k
    return [i for i in range(end) if not bad[i]]


def main_content(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "payload") -> DataFrame:
    """``page_id, line_no``: the lines (cut at newlines, from 1) that carry text of the page's own article.

    Defined cases: a null or blank payload gives no row; a page without an article gives none; a null or broken URL puts the
    page on the host ""; a page fetched again is not held against itself, but against the first page of each of the three
    nearest other paths on both sides; a page without neighbours is judged by what other pages teach about its tags and texts;
    repeated rows of one page give repeated rows; an empty table gives an empty table; lines of any length are read whole;
    other columns are ignored. The result does not depend on partitions.
    """
    d = aligned(pages, page_id, url, payload)
    line = d.where("marked").select("page_id", "host", F.explode(F.arrays_zip("n", "h", "kind", "tag", "flags", "votes")).alias("x")).select("page_id", "host", "x.*")
    fresh = line.where(F.col("flags").bitwiseAND(MORE) == 0)
    n, shared = F.count(F.lit(1)), F.sum((F.col("votes") > 0).cast("double"))
    kinds = stage(fresh.groupBy("host", "kind", "tag").agg(n.alias("n"), shared.alias("shared"), F.bool_or(F.col("flags").bitwiseAND(CLASSED) > 0).alias("classed")), "page-kinds")
    usual = kinds.groupBy("tag").agg((F.sum("shared") / F.sum("n")).alias("usual"))
    part = (F.sum("shared") + PRIOR * F.sum(F.col("n") * F.col("usual")) / F.sum("n")) / (F.sum("n") + PRIOR)
    verdict = kinds.join(usual, "tag").groupBy("host", "kind").agg((F.when(F.max("classed"), part).otherwise(F.max("usual")) > 0.5).alias("bad"))
    judged = line.join(verdict, ["host", "kind"])
    # a text is furniture where the marked-up pages mostly have it as such
    texts = judged.groupBy("h").agg(n.alias("n"), F.avg(F.col("bad").cast("double")).alias("part"), F.bool_or(F.col("votes") > 0).alias("ever")).where("ever OR n > 2").select("h", (F.col("part") > 0.5).alias("known"))
    plain = d.where("NOT marked").select("g", "page_id", F.posexplode(F.arrays_zip("n", "h", "flags", "votes")).alias("i", "x")).select("g", "page_id", "i", "x.*")
    plain = plain.join(texts, "h", "left").groupBy("g", "page_id").agg(F.sort_array(F.collect_list(F.struct("i", "n", "flags", "votes", "known"))).alias("x"))

    def pick(batches):
        for b in batches:
            out = [(pid, x[i]["n"]) for pid, x in zip(b["page_id"], b["x"], strict=True) for i in _choose([t["flags"] for t in x], [t["votes"] for t in x], [t["known"] for t in x])]
            yield pd.DataFrame(out, columns=["page_id", "line_no"])

    chosen = plain.select("page_id", "x").mapInPandas(pick, "page_id long, line_no int")
    return judged.where("NOT bad").select("page_id", F.col("n").alias("line_no")).unionAll(chosen)
