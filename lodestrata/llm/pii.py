"""Personal information inside free text: found by weak supervision, replaced by typed placeholders.

Labelers vote on candidate spans: patterns (the shape of a number, an initial before a word), context (labels, titles, and
tokens beside a span that are learned to stand beside known names, or beside what is none) and a gazetteer (author names,
where a table of them is given). Votes are counted over all texts by pattern of votes, which bounds what the driver sees;
expectation-maximisation over these counts estimates how reliable each labeler is and how likely each pattern is right. The
posteriors train the final classifiers: a logistic model over the letters of a word (given name, surname or neither), and one
logistic model a kind over a span's words, votes, shape and neighbours, which decides on every span.

Texts are read in Arrow batches: one native pass splits them into words and what is between them, and native patterns that
every span of a kind matches decide which texts its exact pattern reads. No pattern reads a part of a text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, stage

#: Classifiers are fitted on all words and kinds of spans: up to so many of them by the driver, more by the tasks, in so many parts.
FIT_ROWS, FIT_PARTS = 400_000, 16
#: Words of the gazetteer (the most frequent ones of the given table).
GAZETTEER = 1_000_000
DIMS = 1 << 16
#: Characters of texts that are split into words at once.
SLICE = 4 << 20

_UP = "A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĘĚĞĢĪİĶĹĽŁŃŇŌŐŒŔŘŚŞŠŢŤŪŮŰŹŻŽ"
# Words that labelers know.
TITLES = "mr mrs ms miss dr prof professor herr frau sr sra mme mlle señor señora doña don sir".split()
PARTICLES = "von van der den de di da del della du la le el al bin ibn ten ter zu zum dos".split()
FIRM = frozenset(
    "ai analytics bio cloud energy health labs lab networks robotics systems works capital ventures venture partners holdings holding angels seed growth fund club ltd inc gmbh corp llc group technologies "
    "software bank media institute college university school polytechnic academy park museum street st road lane court avenue square house platform kit base one go flow desk mint bay city".split()
)
_TITLE_SET = frozenset(TITLES)
#: Endings of files and packages, which an at sign with dots can also have.
_FILES = frozenset("js ts py png jpg jpeg gif svg json html css md txt pdf zip gz exe dll".split())

LABELERS = {
    "email": ("domain", "label", "plain", "not a file"), "phone": ("digits", "label", "prefix", "other number"), "id_number": ("label", "shape", "other number"),
    "address": ("postal code", "label", "other number"), "name": ("title", "before", "after", "initial", "firm", "gazetteer", "pair"),
}


# ---- kinds other than names: candidates and votes -----------------------------------------------------------------
_DOM = r"[a-z0-9][\w-]*"
_EMAIL = re.compile(
    rf"(?<![\w.+@-])[a-z0-9][\w.+-]*(?:@|\s@\s){_DOM}(?:\.{_DOM})*\.[a-z]{{2,}}(?![\w@-])"
    rf"|(?<![\w.+@-])[a-z0-9][\w.+-]*\s?[\[({{]\s?(?:at|ät)\s?[\])}}]\s?{_DOM}(?:(?:\s?[\[({{]\s?(?:dot|punkt|punto|point)\s?[\])}}]\s?|\.){_DOM})+"
    rf"|(?<![\w.+@-])[a-z0-9][\w.+-]*\sat\s{_DOM}(?:\sdot\s{_DOM})+",
    re.I,
)
_EXT = r"(?:\s?(?:x|ext\.?)\s?\d{1,6})?"
_PHONE = re.compile(
    r"(?<![\w.,/+-])(?:"
    r"(?:\+|00)\d{1,3}[\s.-]?(?:\(0\)\s?)?(?:\(?\d{1,5}\)?[\s./-]?){1,6}\d"
    r"|\(\d{3}\)[\s.-]?\d{3}[\s.-]\d{2}\s?\d{2}"
    r"|\d{3}[.-]\d{3}[.-]\d{4}|\d{3}\s\d{3}\s\d{4}"
    r"|07\d{3}\s?\d{3}\s?\d{3}"
    r"|0\d{1,4}/\d{3,8}(?:-\d{1,5})?"
    r"|0\d(?:[.\s]\d{2}){4}"
    rf"){_EXT}(?![\w/]|[.,-]\d)",
)
_ID = re.compile(
    r"(?<![\w.,/+-])(?:\d{3}[- ]\d{2}[- ]\d{4}|\d{9}|[A-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D]|[A-Z]{2}\s\d{3}\s\d{3}|\d{2}\s\d{3}\s\d{3}\s\d{3}|[A-Z]\d{7,8}|[A-Z]\d{3}-\d{4}-\d{4}|\d{6}-\d{4}[A-Z]"
    r"|[A-Z]{2}\d{2}\.\d{3}\.\d{3}-[A-Z]|\d{8}-?[A-Z]|[A-Z]-?\d{7}-?[A-Z])(?![\w-]|[.,]\d)"
)
_ID_LABEL = re.compile(
    r"(?:\b(?:ssn|social\s+security(?:\s+(?:number|no\.?))?|nin|nino|national\s+insurance(?:\s+number)?|insurance\s+(?:number|no\.?)|tax\s+(?:id|number|no\.?)|tin|vat|passport(?:\s+(?:number|no\.?))?|driv(?:er|ing)(?:'s|’s)?\s+licen[cs]e"
    r"|national\s+id|id\s+card|identity\s+(?:card|number)|ausweisnummer|ausweis|personalausweis|reisepass|steuer-?id|steuernummer|sozialversicherungsnummer|führerschein|passeport|permis(?:\s+de\s+conduire)?|num[ée]ro\s+(?:d['’]identit[ée]|fiscal|de\s+sécurité\s+sociale)"
    r"|pasaporte|documento|dni|nie|nif|permiso(?:\s+de\s+conducir)?)(?:\s*(?:n[°º]|n\.\s?º|no\.|nr\.|number|#))?\s*:?\s*)\Z",
    re.I,
)
_NOT_PERSONAL = re.compile(r"\b(?:order\s+no\.?|orders?|part|parts|lot|build|ticket|version|versión|preprint|reference|section|room|table|invoice|serial|model)\s*(?:no\.?|n[°º])?\s*:?\s*\Z", re.I)
_CALL = re.compile(r"(?:\b(?:call|tel|tél|telefon|teléfono|phone|fax|mobile|mobil|cell|rufen\s+sie|appeler\s+le|llame\s+al)\b\.?\s*:?|\(m\))\s*\Z", re.I)

_TOWN = rf"(?:(?:Sankt|Port|Saint|San|Santa|Bad|New|St\.)\s[{_UP}][\w'’-]+|[{_UP}][\w'’-]+(?:\s(?:Bay|City|Beach|Hill|Falls|Springs|Heath))?)"
_NM = rf"[{_UP}][\w'’-]+"
_KIND = r"(?:Street|St\b\.?|Road|Rd\b\.?|Lane|Court|Avenue|Ave\b\.?|Way|Square|Close|Drive|Terrace|Place|Boulevard|Blvd\b\.?|Crescent|Row)"
_PC = r"(?:[A-Z]{1,2}\d[A-Z\d]?\s\d[A-Z]{2}|[A-Z]{2}\s\d{5}(?:-\d{4})?|\d{5})"
_SUB = r"(?:(?:Suite|Apt\.?|Unit|Flat|Floor|Room)\s\d+\w?,\s)"
_TAIL = rf"(?:(?:,\s|\s-\s|\n|\s)(?:[A-Z]{{1,2}}-)?\d{{4,5}}\s{_TOWN}|(?:,\s|\n){_TOWN}(?:,?\s{_PC}(?!\w))?)"
_ADDRESS = re.compile(
    rf"(?<![\w-])(?:"
    rf"{_SUB}?\d{{1,5}}[A-Za-z]?\s{_NM}(?:\s{_NM})?\s{_KIND}(?:,\s(?:Suite|Apt\.?|Unit|Flat|Floor|#)\s?\d+\w?)?{_TAIL}"
    rf"|(?:Flat|Unit|Suite|Apartment)\s\d+\w?,\s{_NM}\s(?:House|Building|Tower|Hall){_TAIL}"
    rf"|(?:PO\sBox|P\.\s?O\.\sBox|Postfach|BP|Apartado(?:\sde\sCorreos)?)\s\d+{_TAIL}"
    rf"|(?:(?:Am|An\sder|Auf\sder|Zum|Zur)\s)?{_NM}(?:straße|strasse|str\.|weg|platz|gasse|allee|ufer|ring|damm)\s\d+\s?[a-z]?{_TAIL}"
    rf"|\d{{1,4}}(?:\s(?:bis|ter|quater))?,?\s(?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|cours)\s(?:(?:de\sla|de|du|des|d['’])\s?)?{_NM}(?:\s{_NM})?{_TAIL}"
    rf"|(?:Calle|C/|Avenida|Avda\.?|Av\.|Plaza|Pza\.?|Paseo|Camino|Ronda)\s?(?:de\s)?{_NM}(?:\s{_NM})?,?\s(?:n\.?º\s?)?\d+(?:,\s\d{{1,2}}\.?[ºª]?\s?[A-Z]?)?{_TAIL}"
    rf")"
)
_AT = re.compile(r"(?:\b(?:seat|office|anschrift|adresse|address|dirección|domicilio|lives\s+at|resides\s+at)\b\s*:?)\s*\Z", re.I)

_MAIL = re.compile(r"(?:\b(?:e-?mail|mail|contact|write\s+to|kontakt|correo|courriel|mailto)\b\s*:?)\s*\Z", re.I)

# What stands between the run before an at sign and the sign goes with the sign.
_AT_SIGN = re.compile(r"(?=[\s@\[({])(?=\s?@|\s?[\[({]\s?(?:at|ät)\s?[\])}]|\sat\s)", re.I)

#: Kinds in order of precedence.
KINDS = ("email", "id_number", "address", "phone")
_PATTERNS = {"email": _EMAIL, "id_number": _ID, "address": _ADDRESS, "phone": _PHONE}


def _implied(pattern: str) -> str:
    """A pattern of the native engine that matches wherever ``pattern`` does: look-around and word edges go, classes widen."""
    p = re.sub(r"\(\?<?[!=](?:[^()\[\]\\]|\\.|\[(?:[^\]\\]|\\.)*\])*\)", "", pattern)
    wide = {"s": r"\s\x0b\x1c-\x1f\x{85}\p{Z}", "w": r"\p{L}\p{M}\p{N}_", "d": r"\p{Nd}"}
    out, inside, i = [], False, 0
    while i < len(p):
        c = p[i]
        if c == "\\":
            n = p[i + 1]
            out.append("" if n == "b" else (wide[n] if inside else f"[{wide[n]}]") if n in wide else c + n)
            i += 2
            continue
        inside = c == "[" or inside and c != "]"
        out.append(c)
        i += 1
    return "".join(out)


# The address pattern is too large for the native engine; every alternative of it has one of these parts.
_W1, _SP = r"[^\s\p{Z}]+(?:[\s\p{Z}][^\s\p{Z}]+)?", r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_GATES = {k: _implied(r.pattern) for k, r in _PATTERNS.items()} | {
    "address": rf"\p{{Nd}}[A-Za-z]?{_SP}{_W1}{_SP}(?:Street|St|Road|Rd|Lane|Court|Ave|Way|Square|Close|Drive|Terrace|Place|Boulevard|Blvd|Crescent|Row)"
    rf"|(?:Flat|Unit|Suite|Apartment){_SP}\p{{Nd}}|(?:Box|Postfach|BP|Apartado|Correos?){_SP}\p{{Nd}}"
    rf"|(?:straße|strasse|str\.|weg|platz|gasse|allee|ufer|ring|damm){_SP}\p{{Nd}}"
    rf"|\p{{Nd}}(?:{_SP}(?:bis|ter|quater))?,?{_SP}(?:rue|avenue|boulevard|place|chemin|allée|impasse|quai|cours){_SP}"
    rf"|(?:Calle|C/|Avenida|Avda|Av\.|Plaza|Pza|Paseo|Camino|Ronda)(?:\.?){_SP}?(?:de{_SP})?{_W1}{_SP}(?:n\.?º{_SP}?)?\p{{Nd}}"
}


def _votes(kind: str, text: str, s: int, e: int) -> tuple:
    x, b = text[s:e], text[max(0, s - 60) : s]
    if kind == "email":
        last = re.split(r"[.\s)\]}]+", x.lower())[-1]
        return 1 if 2 <= len(last) <= 24 and last.isalpha() else -1, int(bool(_MAIL.search(b))), int("@" in x and " " not in x), -1 if last in _FILES else 0
    other = -1 if _NOT_PERSONAL.search(b) else 0
    if kind == "phone":
        n = sum(c.isdigit() for c in x)
        return 1 if 9 <= n <= 20 else -1, int(bool(_CALL.search(b))), int(x[0] in "+(" or x.startswith("00")), -1 if other or _ID_LABEL.search(b) else 0
    if kind == "id_number":
        return int(bool(_ID_LABEL.search(b))), int(not x.isdigit()), -1 if other or _CALL.search(b) else 0
    return int(bool(re.search(r"\d{4,5}|[A-Z\d]{2,4}\s\d[A-Z]{2}\Z", x))), int(bool(_AT.search(b))), other


def _mails(text: str):
    """Matches of ``_EMAIL``: one can only begin where the run of letters, digits, points and signs before an at sign begins."""
    done = 0
    for m in _AT_SIGN.finditer(text):
        s = m.start()
        if s < done:
            continue
        while s > done and (text[s - 1].isalnum() or text[s - 1] in "_.+-"):
            s -= 1
        if x := _EMAIL.match(text, s):
            done = x.end()
            yield x
        else:
            done = max(done, m.start())  # no later sign's run reaches further back


def _candidates(texts: pa.Array):
    """(text number, kind, start, end, votes, hashed features) of all spans that have the shape of a kind."""
    for kind in KINDS:
        find = _mails if kind == "email" else _PATTERNS[kind].finditer
        for i in np.flatnonzero(pc.match_substring_regex(texts, _GATES[kind], ignore_case=kind == "email").to_numpy(zero_copy_only=False)):
            t = texts[int(i)].as_py()
            for m in find(t):
                s, e = m.span()
                v = _votes(kind, t, s, e)
                yield int(i), kind, s, e, v, _span_features(kind, v, t[max(0, s - 60) : s], t[s:e], t[e : e + 20])


def _span_features(kind: str, votes: tuple, before: str, span: str, after: str) -> list[int]:
    """Votes, shape and neighbours of a span as places of the classifier's weights (the first votes' places are its kind's own)."""
    near = re.findall(r"\w+|[^\w\s]", before.lower())[-2:]
    nxt = re.findall(r"\w+|[^\w\s]", after.lower())[:1]
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"\d", "0", span)) if kind in ("phone", "id_number") else str(span.count(" "))
    f = [f"v{k}={x}" for k, x in enumerate(votes)] + [f"shape={shape[:40]}", f"near={'|'.join(near)}", *(f"in={x}" for x in near), *(f"next={x}" for x in nxt)]
    return [zlib.crc32(f"{kind} {x}".encode()) % DIMS for x in f]




# ---- words of texts ------------------------------------------------------------------------------------------------


class Words:
    """The words of some texts as parallel arrays: numbers in ``vocab`` of the word and of what is before and after it, the
    number of its text, and its place there in code points. One native pass, no loop over words."""

    def __init__(self, texts: pa.Array):
        x = pc.replace_substring_regex(pc.replace_substring(texts, "\x00", " "), r"([\p{L}\p{M}]+)", "\x00\\1\x00")
        parts = pc.split_pattern(x, "\x00")
        enc = parts.flatten().dictionary_encode()
        self.vocab: list[str] = enc.dictionary.to_pylist()
        ids, sizes = enc.indices.to_numpy().astype(np.int64), parts.value_lengths().to_numpy().astype(np.int64)
        lens = np.array([len(v) for v in self.vocab], np.int64)
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        begin = np.cumsum(lens[ids]) - lens[ids]
        at = np.flatnonzero((np.arange(len(ids)) - first) % 2 == 1)  # texts begin and end with what is no word
        self.w, self.before, self.after = ids[at], ids[at - 1], ids[at + 1]
        self.doc = np.repeat(np.arange(len(sizes)), sizes)[at]
        self.start = (begin - begin[first])[at] if len(ids) else at
        self.end = self.start + lens[self.w]
        self.low = [v.lower() for v in self.vocab]

    def table(self, f) -> np.ndarray:
        return np.fromiter((f(v) for v in self.vocab), bool, len(self.vocab))


def _slices(texts: pa.Array):
    """(number of the first text, texts) in parts of about ``SLICE`` characters."""
    n = pc.utf8_length(texts).to_numpy().astype(np.int64)
    part = np.cumsum(n) // SLICE
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, z in zip([0, *cuts], [*cuts, len(texts)], strict=True):
        if z > a:
            yield int(a), texts.slice(int(a), int(z - a))


def _token_before(word: str, sep: str) -> str:
    """What stands before a span: the start of a line or sentence, or a word and its marks."""
    if "\n" in sep or not word:
        return "\n" + sep.rsplit("\n", 1)[-1].strip()[:3]
    sep = sep.strip()
    return "." + sep[1:4] if sep[:1] in (".", "!", "?") and word not in _TITLE_SET else word + sep[:3]


def _token_after(word: str, sep: str) -> str:
    sep = sep.lstrip(" \u00a0")
    return "\n" if sep[:1] == "\n" else "." if sep[:1] in (".", "!", "?") else f"{sep.strip()[:2]} {word}" if word else "\n"


_JOIN = (" ", "\u00a0", ". ", ".\u00a0")


class Runs:
    """Capitalised runs of one to three whole words, initials apart, as candidates for names: numbers of given name (-1: none)
    and surname in the vocabulary, tokens beside them, and the votes that need no learning."""

    def __init__(self, w: Words, small: frozenset):
        v, n = w.vocab, len(w.w)
        up = w.table(lambda x: x[:1].isupper())
        join, glued = w.table(_JOIN.__contains__), w.table(lambda x: x[-1:] in tuple("@.+-_") or x[-1:].isdigit())
        size = np.fromiter((len(x) for x in v), np.int64, len(v))
        strip = np.fromiter((x in small or x in _TITLE_SET for x in w.low), bool, len(v))
        title, firm = np.fromiter((x in _TITLE_SET for x in w.low), bool, len(v)), np.fromiter((x in FIRM for x in w.low), bool, len(v))
        cap = up[w.w] & ~glued[w.before]
        same = np.zeros(n, bool)
        same[1:] = w.doc[1:] == w.doc[:-1]
        more = np.zeros(n, bool)
        more[1:] = cap[1:] & cap[:-1] & same[1:] & join[w.before[1:]]
        s = np.flatnonzero(cap & ~more)
        ends = np.flatnonzero(cap & ~np.append(more[1:], False))
        for _ in range(6):  # words before a name that are mostly written small, and titles
            s = s + ((s < ends) & strip[w.w[s]])
        k = ends - s + 1
        full = np.concatenate([[0], np.cumsum(size[w.w] > 1)])
        whole = full[ends + 1] - full[s]
        ok = (k <= 8) & (whole >= 1) & (whole <= 3)
        s, ends, whole = s[ok], ends[ok], whole[ok]
        # the full words of each run, in order
        pos = np.flatnonzero(size[w.w] > 1)
        f0 = full[s]
        one = pos[f0] if len(s) else s
        two = np.where(whole > 1, pos[np.minimum(f0 + 1, len(pos) - 1)], -1) if len(s) else s
        three = np.where(whole > 2, pos[np.minimum(f0 + 2, len(pos) - 1)], -1) if len(s) else s
        is_firm = ((two >= 0) & firm[w.w[two]]) | ((three >= 0) & firm[w.w[three]])
        odd = w.table(lambda x: x[:1] == "/" or len(x) > 1 and x[0] == " " and x[1].isdigit())
        mates = w.table(lambda x: x.strip()[:1] in ("&", "+") or x.strip()[-1:] in ("&", "+"))
        is_firm |= odd[w.after[ends]]
        keep = ((whole < 3) | is_firm) & ~mates[w.after[ends]] & ~mates[w.before[s]]  # partners in a firm's name are no mentions
        s, ends, whole, one, two, is_firm = (x[keep] for x in (s, ends, whole, one, two, is_firm))
        lone = is_firm | (whole == 1)
        self.a, self.b = np.where(lone, -1, w.w[one]), np.where(lone, w.w[one], w.w[two])
        prev = np.where(same[s], w.w[s - 1], -1)
        last = np.minimum(ends + 1, n - 1)
        nxt = np.where((ends + 1 < n) & same[last], w.w[last], -1)
        self.before, self.before_at = self._tokens(w, prev, w.before[s], _token_before)
        self.after, self.after_at = self._tokens(w, nxt, w.after[ends], _token_after)
        titled = (prev >= 0) & title[prev]
        initial = (ends - s + 1 > whole) & (whole > 0)
        self.fixed = np.stack([titled.astype(np.int8), initial.astype(np.int8), -is_firm.astype(np.int8), (self.a >= 0).astype(np.int8)], 1)

    @staticmethod
    def _tokens(w: Words, word, sep, f) -> tuple[list[str], np.ndarray]:
        u, at = np.unique((word + 1) * len(w.vocab) + sep, return_inverse=True)
        return [f(w.low[x // len(w.vocab) - 1] if x >= len(w.vocab) else "", w.vocab[x % len(w.vocab)]) for x in u.tolist()], at

    def votes(self, w: Words, ctx: Context) -> np.ndarray:
        """One row of votes a run, in the order of ``LABELERS["name"]``."""
        near = [np.array([side.get(t, 0) for t in toks] or [0], np.int8)[at] for side, toks, at in ((ctx.before, self.before, self.before_at), (ctx.after, self.after, self.after_at))]
        t, i, f, p = self.fixed.T
        return np.stack([t, *near, i, f, self.known(w, ctx.gazetteer), p], 1).astype(np.int8)

    def known(self, w: Words, gazetteer: frozenset | None) -> np.ndarray:
        """1: all words are in the gazetteer, -1: not all, 0: there is none."""
        if gazetteer is None:
            return np.zeros(len(self.b), np.int8)
        g = np.fromiter((x in gazetteer for x in w.low), bool, len(w.low))
        return np.where(g[self.b] & ((self.a < 0) | g[self.a]), 1, -1).astype(np.int8) if len(self.b) else np.zeros(0, np.int8)


class Context:
    """What is learned before votes are counted: tokens beside names (1) and beside what is none (-1), words mostly written small, known names."""

    def __init__(self, before: dict, after: dict, small: frozenset, gazetteer: frozenset | None):
        self.before, self.after, self.small, self.gazetteer = before, after, small, gazetteer


# ---- learning -----------------------------------------------------------------------------------------------------


def em(votes: np.ndarray, counts: np.ndarray, steps: int = 60, prior: float | None = None) -> tuple[np.ndarray, dict]:
    """Posterior of "right" for each pattern of votes (rows; -1, 0, 1), and each labeler's reliabilities, by expectation-maximisation.

    The start is the majority; every labeler has its own distribution of votes for right and for wrong spans.
    """
    sgn = votes.sum(1)
    post = np.clip(0.5 + 0.3 * sgn, 0.05, 0.95)
    table = np.zeros((2, votes.shape[1], 3))
    for _ in range(steps):
        p = float((post * counts).sum() / counts.sum()) if prior is None else prior
        p = min(max(p, 1e-4), 1 - 1e-4)
        ll = np.zeros((2, len(votes)))
        for z, w in ((0, (1 - post) * counts), (1, post * counts)):
            for k in range(votes.shape[1]):
                n = np.array([w[votes[:, k] == v].sum() for v in (-1, 0, 1)]) + 0.5
                table[z, k] = n / n.sum()
                ll[z] += np.log(table[z, k][votes[:, k] + 1])
        d = np.clip(ll[1] + np.log(p) - ll[0] - np.log(1 - p), -30, 30)
        new = 1 / (1 + np.exp(-d))
        if np.abs(new - post).max() < 1e-5:
            post = new
            break
        post = new
    return post, {"right": table[1].tolist(), "wrong": table[0].tolist(), "share": p}


def majority(votes: np.ndarray) -> np.ndarray:
    """What a plain majority of votes says, to hold the estimates against."""
    return (votes.sum(1) > 0).astype(float)


def _word_features(w: str) -> list[int]:
    f = ["w" + w, "p" + w[:2], "p" + w[:3], "p" + w[:4], "s" + w[-2:], "s" + w[-3:], "s" + w[-4:], "s" + w[-5:], f"l{min(len(w), 14)}"]
    return [zlib.crc32(x.encode()) % DIMS for x in f]


def _arrays(t, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (DIMS + 1 pads), labels and weights of an Arrow table's rows."""
    x, y, weight = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (t.column(n) for n in ("x", "y", "weight")))
    size = pc.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int64)
    places = np.full((len(size), max(size, default=1)), DIMS + 1, np.int32)
    places[np.arange(places.shape[1]) < size[:, None]] = x.flatten().to_numpy()
    return places, y.flatten().to_numpy().reshape(-1, k), weight.to_numpy()


def _gradient(w: np.ndarray, x: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """What some rows add to the gradient; the row DIMS is the bias, DIMS + 1 pads."""
    g = np.zeros_like(w)
    for s in range(0, len(x), 1 << 16):  # bounds the gathered weights
        part = x[s : s + (1 << 16)]
        r = weight[s : s + (1 << 16), None] * (1 / (1 + np.exp(-np.clip(w[part].sum(1) + w[DIMS], -30, 30))) - labels[s : s + (1 << 16)])
        for j in range(w.shape[1]):
            g[:, j] += np.bincount(part.ravel(), np.repeat(r[:, j], part.shape[1]), DIMS + 2)
            g[DIMS, j] += r[:, j].sum()
    return g


def _descend(gradient, k: int, steps: int = 80) -> np.ndarray:
    """Weights (DIMS + 2, k) of logistic models on soft labels (AdaGrad, whole batches)."""
    w, g2 = np.zeros((DIMS + 2, k)), np.full((DIMS + 2, k), 1e-8)
    for _ in range(steps):
        g = 2e-3 * w + gradient(w)
        g2 += g * g
        w -= 0.3 * g / np.sqrt(g2)
        w[DIMS + 1] = 0
    return w.astype(np.float32)


def fit(rows: DataFrame, k: int, steps: int = 80) -> np.ndarray:
    """Weights of the models for ``x`` (places of weights), ``y`` (k labels), ``weight`` of all rows. Few rows are fitted by the driver,
    many where they are: each step, every task sums the gradient of its rows. Both give the same but for rounding."""
    spark = rows.sparkSession
    rows = stage(rows, "to-fit")
    if rows.count() <= FIT_ROWS:
        here = _arrays(rows.orderBy("x", "weight", "y").toArrow(), k)
        discard(rows)
        return _descend(lambda w: _gradient(w, *here), k, steps)
    parts = stage(rows.repartition(FIT_PARTS), "to-fit-parts")
    discard(rows)

    def gradient(w: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(w)

        def run(batches):
            g = np.zeros_like(shared.value)
            for b in batches:
                g += _gradient(shared.value, *_arrays(b, k))
            yield pa.RecordBatch.from_arrays([pa.array([g.tobytes()], pa.binary())], ["g"])

        out = parts.coalesce(FIT_PARTS).mapInArrow(run, "g binary").collect()
        shared.destroy()
        return sum(np.frombuffer(r.g).reshape(w.shape) for r in out)

    w = _descend(gradient, k, steps)
    discard(parts)
    return w


def _levels(given: float, sur: float) -> tuple[int, int]:
    return max(-6, min(6, round(given))), max(-6, min(6, round(sur)))


def _name_features(given: int, sur: int, votes: tuple) -> list[int]:
    """The word model's opinion on both words and the votes, as places of the classifier's weights."""
    f = [f"given={given}", f"sur={sur}", f"both={given},{sur}", *(f"v{k}={x}" for k, x in enumerate(votes))]
    return [zlib.crc32(f"name {x}".encode()) % DIMS for x in f]


class Finder:
    """The final classifiers: finds the mentions of texts."""

    def __init__(self, ctx: Context, words: np.ndarray, spans: np.ndarray):
        self.ctx, self.w, self.spans_w, self.cache, self.judged = ctx, words, spans[:, 0], {}, {}

    def logits(self, w: str) -> tuple[float, float]:
        """How likely a word (in small letters) is a given name and a surname."""
        k = self.cache.get(w)
        if k is None:
            g, s = self.w[_word_features(w)].sum(0) + self.w[DIMS] if len(w) > 2 and w not in FIRM and w not in _TITLE_SET else (-30.0, -30.0)
            if len(self.cache) > 500_000:
                self.cache.clear()
            k = self.cache[w] = float(g), float(s)
        return k

    def kind(self, t: str) -> int:
        """0 neither, 1 given name, 2 surname."""
        g, s = self.logits(t.lower())
        return 0 if max(g, s) <= 0 or t[0].islower() and len(t) < 4 else 1 if g > s else 2

    def right(self, features: list[int]) -> bool:
        return float(self.spans_w[features].sum() + self.spans_w[DIMS]) > 0

    def is_name(self, given: str, sur: str, votes: tuple) -> bool:
        key = *_levels(self.logits(given)[0] if given else -6.0, self.logits(sur)[1]), votes
        k = self.judged.get(key)
        if k is None:  # levels and votes have few values
            k = self.judged[key] = self.right(_name_features(*key))
        return k

    def spans(self, texts: pa.Array):
        """(text number, kind, start, end), ordered by text and start; mentions do not overlap."""
        for first, part in _slices(texts):
            found: dict[int, list] = {}
            for i, kind, s, e, _, f in _candidates(part):
                mine = found.setdefault(i, [])
                if self.right(f) and not any(s < z and a < e for _, a, z in mine):
                    mine.append((kind, s, e))
            for i, s, e in self._names(part):
                mine = found.setdefault(i, [])
                if not any(s < z and a < e for k, a, z in mine if k != "name"):
                    mine.append(("name", s, e))
            for i in sorted(found):
                for kind, s, e in sorted(found[i], key=lambda x: x[1]):
                    yield first + i, kind, s, e

    def _names(self, texts: pa.Array):
        w = Words(texts)
        kinds = np.fromiter((self.kind(x) if x[:1].isalpha() else 0 for x in w.vocab), np.int8, len(w.vocab))
        hit = np.flatnonzero(kinds[w.w]) if len(w.w) else np.empty(0, np.int64)
        if not len(hit):
            return
        low, before, after, gaz = w.low, self.ctx.before, self.ctx.after, self.ctx.gazetteer
        doc = w.doc[hit]
        cuts = [0, *(np.flatnonzero(np.diff(doc)) + 1).tolist(), len(hit)]
        start, end, kind, doc = w.start[hit].tolist(), w.end[hit].tolist(), kinds[w.w[hit]].tolist(), doc.tolist()
        hit, docs, starts, ends, word, prior, later = hit.tolist(), *(memoryview(x) for x in (w.doc, w.start, w.end, w.w, w.before, w.after))
        for a, z in zip(cuts, cuts[1:], strict=False):
            text, d = texts[doc[a]].as_py(), doc[a]
            for s, e, i, j in self._assemble(text, list(zip(start[a:z], end[a:z], kind[a:z], strict=True))):
                x, y = hit[a + i], hit[a + j]  # first and last word that have a kind
                while x and docs[x - 1] == d and starts[x] > s:
                    x -= 1
                while y + 1 < len(word) and docs[y + 1] == d and ends[y] < e:
                    y += 1
                pw = low[word[x - 1]] if x and docs[x - 1] == d else ""
                nw = low[word[y + 1]] if y + 1 < len(word) and docs[y + 1] == d else ""
                named = [low[word[hit[a + h]]] for h in range(i, j + 1)]
                given = next((t for h, t in enumerate(named) if kind[a + i + h] == 1), "")
                sur = next((t for h, t in enumerate(named) if kind[a + i + h] == 2), named[-1])
                g = 0 if gaz is None else 1 if sur in gaz and (not given or given in gaz) else -1
                v = (
                    int(pw in _TITLE_SET), before.get(_token_before(pw, w.vocab[prior[x]]), 0), after.get(_token_after(nw, w.vocab[later[y]]), 0),
                    int(bool(_INITIAL.search(text, s, e))), 0, g, int(bool(given)),
                )
                if self.is_name(given, sur, v):
                    yield d, s, e

    def _assemble(self, text: str, hits: list[tuple[int, int, int]]):
        """(start, end, first hit, last hit) of mentions put together from words that are given names or surnames."""
        n, i, done = len(hits), 0, -1
        while i < n:
            s, e, k = hits[i]
            if s < done or (s and text[s - 1] in "@_+.\\" and not (text[s - 1] == "." and s > 1 and text[s - 2].isupper())) or text[e : e + 1] in ("@", "_", "\\"):
                i += 1
                continue
            if k == 1:  # given name: up to its surname
                j, end = i + 1, -1
                if j < n and hits[j][2] == 2 and _BETWEEN.fullmatch(text, e, hits[j][0]):
                    end, j = self._surname(text, hits, j)
                elif j < n and hits[j][2] == 1 and _BETWEEN.fullmatch(text, e, hits[j][0]) and j + 1 < n and hits[j + 1][2] == 2 and _BETWEEN.fullmatch(text, hits[j][1], hits[j + 1][0]):
                    end, j = self._surname(text, hits, j + 1)
                if end > 0 and not self._firm(text, s, end):
                    yield s, end, i, j - 1
                    done = end
                i = max(j, i + 1)
                continue
            end, j = self._surname(text, hits, i)
            # two of them on one line are one person, whose given name may be unknown
            if j < n and hits[j][2] == 2 and "\n" not in text[end : hits[j][0]] and _BETWEEN.fullmatch(text, end, hits[j][0]):
                end, j = self._surname(text, hits, j)
            # "Surname, Given K."
            if j < n and hits[j][2] == 1 and text[end : hits[j][0]] in (", ", ",\n", ",\u00a0") and not (j + 1 < n and hits[j + 1][2] == 2 and _BETWEEN.fullmatch(text, hits[j][1], hits[j + 1][0])):
                full = hits[j][1]
                x = _INITIALS_AFTER.match(text, full)
                full = x.end() if x else full
                if text[s].isupper():
                    s2 = self._left(text, s, particles_only=True)
                    yield s2, full, i, j
                    done = full
                    i = j + 1
                    continue
            s2 = self._left(text, s)
            if (text[s].isupper() or s2 < s) and not self._firm(text, s2, end):
                yield s2, end, i, j - 1
                done = end
            i = max(j, i + 1)

    @staticmethod
    def _surname(text, hits, j):
        """End of the surname at hit j, with what is joined by hyphens, and the next hit."""
        end = hits[j][1]
        j += 1
        while j < len(hits) and hits[j][0] == end + 1 and text[end] in "-‐‑":
            end = hits[j][1]
            j += 1
        if (x := _HYPHENED.match(text, end)) and text[end + 1].isupper():
            end = x.end()
        return end, j

    @staticmethod
    def _left(text, s, particles_only=False):
        """Start of a mention whose surname begins at s: with particles and, before them, initials."""
        b = text[max(0, s - 40) : s]
        m = _PARTICLE_END.search(b)
        if m:
            s -= len(b) - m.start()
            b = b[: m.start()]
        if not particles_only and (m := _INITIAL_END.search(b)):
            s -= len(b) - m.start()
        return s

    @staticmethod
    def _firm(text, s, e):
        """Whether a mention is part of a firm's or product's name or of a web address."""
        m = _NEXT.match(text, e)
        if m and (m[1] or m[2][0].isupper() and m[2].lower() in FIRM):
            return True
        k = s
        while k and text[k - 1].isspace():
            k -= 1
        if k and text[k - 1] in "&+":
            return True
        if k == s:
            while k and not text[k - 1].isspace():
                k -= 1
        return "://" in text[k:s] or "www." in text[k:s]


_NEXT = re.compile(r"\s*([&+])\s*\S|[ \u00a0]([^\W\d_]+)")
_BETWEEN = re.compile(rf"[\s ]{{1,3}}(?:[{_UP}]\.[\s ]{{0,3}}){{0,3}}(?:(?:(?:{'|'.join(PARTICLES)})[\s ]{{1,3}}){{1,3}}|(?:al|el|d|o)[-'’])?", re.I)
_PARTICLE_END = re.compile(rf"(?:\b(?:{'|'.join(PARTICLES)})[\s ]{{1,2}}){{1,3}}\Z|\b(?:[Aa]l|[Ee]l|[Dd]|[Oo])[-'’]\Z")
_INITIAL_END = re.compile(rf"(?<![\w.])(?:[{_UP}]\.[\s ]?)+\Z")
_INITIALS_AFTER = re.compile(rf"(?:[\s][{_UP}]\.)+")
_INITIAL = re.compile(rf"(?<!\w)[{_UP}]\.")
_HYPHENED = re.compile(r"[-‐‑][^\W\d_]+")


def _gazetteer(authors: DataFrame | None, column: str) -> frozenset | None:
    """Words of people's names in a table, at least twice there; the ``GAZETTEER`` most frequent ones."""
    if authors is None:
        return None
    # words with figures or escapes in them are none
    words = authors.select(F.explode(F.split(F.lower(F.col(f"`{column}`")), r"[^\p{L}\p{M}\p{N}\\]+")).alias("w")).where(F.col("w").rlike(r"^[\p{L}\p{M}]{3,}$")).groupBy("w").count().where("count > 1").where(~F.col("w").isin("and", "et", "und", *PARTICLES))
    rows = words.orderBy(F.desc("count"), "w").limit(GAZETTEER).select("w").collect()
    return frozenset(r.w for r in rows) or None


def _table(rows: list, schema: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ((),) * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64() if c in ("n", "hits") else pa.string()) for c, x in zip(schema, columns, strict=True)], schema)


def learn_context(texts: DataFrame, gazetteer: frozenset | None) -> Context:
    """Tokens that stand beside known names clearly more, or less, often than beside other capitalised runs, in all texts; words
    mostly, but not always, written small. Known are names of the gazetteer or, where there is none, words that stand after titles at least twice."""
    known = gazetteer
    if known is None:

        def titled(batches):
            for b in batches:
                n: Counter = Counter()
                for _, part in _slices(b.column("t")):
                    w = Words(part)
                    r = Runs(w, frozenset())
                    at = np.flatnonzero(r.fixed[:, 0])
                    n.update(w.low[x] for x in (*r.a[at].tolist(), *r.b[at].tolist()) if x >= 0)
                yield _table(list(n.items()), ["t", "n"])

        rows = texts.mapInArrow(titled, "t string, n long").groupBy("t").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "t").limit(GAZETTEER).collect()
        known = frozenset(r.t for r in rows)
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        gaz, none = shared.value, frozenset()
        for b in batches:
            n: Counter = Counter()
            hits: Counter = Counter()
            for _, part in _slices(b.column("t")):
                w = Words(part)
                up = np.bincount(w.w, minlength=len(w.vocab))
                for x, low, c in zip(w.vocab, w.low, up.tolist(), strict=True):
                    if c and len(x) > 1:
                        n["word", low] += c
                        if x[0].islower():
                            hits["word", low] += c
                r = Runs(w, none)
                y = r.known(w, gaz) > 0
                for side, toks, at in (("before", r.before, r.before_at), ("after", r.after, r.after_at)):
                    for t, c, h in zip(toks, np.bincount(at, minlength=len(toks)).tolist(), np.bincount(at, y, len(toks)).astype(int).tolist(), strict=True):
                        n[side, t] += c
                        hits[side, t] += h
            yield _table([(k, t, c, hits[k, t]) for (k, t), c in n.items()], ["side", "t", "n", "hits"])

    seen = texts.mapInArrow(count, "side string, t string, n long, hits long").groupBy("side", "t").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    seen = stage(seen.where("n >= 5"), "neighbours")
    # what is never written large begins no run
    small = frozenset(r.t for r in seen.where("side = 'word' AND 2 * hits > n AND hits < n").select("t").collect())
    base = {r.side: (r.hits + 1) / (r.n + 2) for r in seen.groupBy("side").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")).collect()}
    sides = {}
    for side in ("before", "after"):
        share = base.get(side, 0.5)
        most, rate = max(0.5, min(0.9, 2 * share)), (F.col("hits") + 2 * share) / (F.col("n") + 2)
        rows = seen.where(F.col("side") == side).select("t", (rate > most).alias("more"), (rate < share / 3).alias("less")).where("more OR less").collect()
        sides[side] = {r.t: 1 if r.more else -1 for r in rows}
    discard(seen)
    return Context(sides["before"], sides["after"], small, gazetteer)


def train(docs: DataFrame, authors: DataFrame | None = None, text: str = "text", author_column: str = "authors") -> tuple[Finder, dict]:
    """(the finder, per kind: labelers' reliabilities, patterns of votes with their counts and posteriors), from the votes on all texts."""
    texts = docs.select(F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    ctx = learn_context(texts, _gazetteer(authors, author_column))
    shared = docs.sparkSession.sparkContext.broadcast(ctx)
    schema = ["kind", "a", "s", "v", "f", "n"]

    def count(batches):
        c = shared.value
        for b in batches:
            n: Counter = Counter()
            for _, part in _slices(b.column("t")):
                for _, kind, _, _, v, f in _candidates(part):
                    n[kind, "", "", v, " ".join(map(str, f))] += 1
                w = Words(part)
                small = np.bincount(w.w, minlength=len(w.vocab)) * np.fromiter((len(x) > 2 and x.islower() and x.isalpha() for x in w.vocab), bool, len(w.vocab)) if len(w.w) else np.zeros(0, int)
                for k in np.flatnonzero(small).tolist():  # a word mostly written small is no name
                    n["small", "", w.vocab[k], (), ""] += int(small[k])
                r = Runs(w, c.small)
                v = r.votes(w, c)
                code = (v.astype(np.int64) + 1) @ 3 ** np.arange(v.shape[1])
                _, at, inv = np.unique(((r.a + 1) * len(w.vocab) + r.b) * 3 ** v.shape[1] + code, return_index=True, return_inverse=True)
                for k, m in zip(at.tolist(), np.bincount(inv, minlength=len(at)).tolist(), strict=True):
                    n["name", w.low[r.a[k]] if r.a[k] >= 0 else "", w.low[r.b[k]], tuple(v[k].tolist()), ""] += m
            yield _table([(k, a, s, ",".join(map(str, v)), f, m) for (k, a, s, v, f), m in n.items()], schema)

    # every text votes, so that no pattern of votes meets the finder unscored
    votes = texts.mapInArrow(count, "kind string, a string, s string, v string, f string, n long")
    votes = stage(votes.groupBy("kind", "a", "s", "v", "f").agg(F.sum("n").alias("n")), "votes")
    patterns = votes.where("kind <> 'small'").groupBy("kind", "v").agg(F.sum("n").alias("n")).orderBy("kind", "v").collect()
    posts, report = {}, {}
    for kind in sorted({r.kind for r in patterns}):
        rows = [r for r in patterns if r.kind == kind]
        v, n = np.array([[int(x) for x in r.v.split(",")] for r in rows]), np.array([r.n for r in rows], float)
        post, rel = em(v, n)
        report[kind] = {"labelers": rel, "votes": v, "counts": n, "posterior": post}
        posts |= {(kind, r.v): float(p) for r, p in zip(rows, post, strict=True)}
    spark = docs.sparkSession
    p = spark.createDataFrame([(k, v, q) for (k, v), q in posts.items()] or [("", "", 0.0)], "kind string, v string, p double")
    scored = votes.where("kind <> 'small'").join(F.broadcast(p), ["kind", "v"])
    named, zero = scored.where("kind = 'name'"), F.lit(0.0)
    each = named.where("a <> ''").select(F.col("a").alias("w"), (F.col("n") * F.col("p")).alias("g"), zero.alias("s"), "n").unionAll(named.select(F.col("s").alias("w"), zero.alias("g"), (F.col("n") * F.col("p")).alias("s"), "n"))
    each = each.unionAll(votes.where("kind = 'small'").select(F.col("s").alias("w"), zero.alias("g"), zero.alias("s"), "n"))
    words = each.groupBy("w").agg(F.sum("g").alias("g"), F.sum("s").alias("s"), F.sum("n").alias("n"))
    weight = lambda n: F.least(n.cast("double"), F.lit(20.0))

    def places(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_word_features(x) for x in b.column("w").to_pylist()], pa.list_(pa.int32())), b.column("y"), b.column("weight")], ["x", "y", "weight"])

    to_fit = "x array<int>, y array<double>, weight double"
    w = fit(words.select("w", F.array(F.col("g") / F.col("n"), F.col("s") / F.col("n")).alias("y"), weight(F.col("n")).alias("weight")).mapInArrow(places, to_fit), 2)
    finder = spark.sparkContext.broadcast(Finder(None, w, np.zeros((DIMS + 2, 1), np.float32)))

    def judged(batches):
        f = finder.value
        for b in batches:
            c: Counter = Counter()
            for a, x, v, p, n in zip(*(b.column(k).to_pylist() for k in ("a", "s", "v", "p", "n")), strict=True):
                c[(*_levels(f.logits(a)[0] if a else -6.0, f.logits(x)[1]), v, p)] += min(n, 20)
            rows = [(_name_features(g, s, tuple(v.split(","))), [p], float(n)) for (g, s, v, p), n in c.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.list_(pa.int32()), pa.list_(pa.float64()), pa.float64()))], ["x", "y", "weight"])

    # names of one level and one pattern of votes are one row, which weighs as much as all of them
    named = named.select("a", "s", "v", "p", "n").mapInArrow(judged, to_fit).groupBy("x", "y").agg(F.sum("weight").alias("weight"))
    other = scored.where("kind <> 'name'").select(F.split("f", " ").cast("array<int>").alias("x"), F.array("p").alias("y"), weight(F.col("n")).alias("weight"))
    spans = fit(named.unionByName(other), 1)
    discard(votes)
    return Finder(ctx, w, spans), report


def find_pii(docs: DataFrame, authors: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, kind, start_pos, end_pos``: one row per mention, positions in code points from 0, end exclusive.

    Defined cases: a null or empty text has no mention; repeated rows give repeated mentions; texts and mentions of any length
    are read whole; an empty table gives an empty table; mentions do not overlap: e-mail address, number, address, phone and
    name take precedence in this order; other columns are ignored.
    """
    finder, _ = train(docs, authors, text)
    shared = docs.sparkSession.sparkContext.broadcast(finder)

    def run(batches):
        f = shared.value
        for b in batches:
            out = list(f.spans(b.column("t")))
            ids = b.column("doc_id").take(pa.array([x[0] for x in out], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([x[1] for x in out], pa.string()), pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.int64())], ["doc_id", "kind", "start_pos", "end_pos"])

    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t")).where("t IS NOT NULL")
    return d.mapInArrow(run, "doc_id long, kind string, start_pos long, end_pos long")


def mask_pii(docs: DataFrame, authors: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, mentions``: every text with its mentions replaced by ``[EMAIL]``, ``[PHONE]``, ``[ID_NUMBER]``, ``[ADDRESS]`` or ``[NAME]``."""
    finder, _ = train(docs, authors, text)
    shared = docs.sparkSession.sparkContext.broadcast(finder)

    def run(batches):
        f = shared.value
        for b in batches:
            texts = b.column("text").to_pylist()
            at: dict[int, list] = {}
            for i, kind, s, e in f.spans(b.column("text").fill_null("")):
                at.setdefault(i, []).append((kind, s, e))
            for i, mine in at.items():
                parts, last = [], 0
                for kind, s, e in mine:
                    parts += [texts[i][last:s], f"[{kind.upper()}]"]
                    last = e
                texts[i] = "".join(parts) + texts[i][last:]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), pa.array([len(at.get(i, ())) for i in range(len(texts))], pa.int64())], ["doc_id", "text", "mentions"])

    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return d.mapInArrow(run, "doc_id long, text string, mentions long")
