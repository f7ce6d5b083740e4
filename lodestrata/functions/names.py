"""Entity names, slugs and identifiers, hashes and small text helpers as native expressions (NFKD in Arrow batches)."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Legal suffixes (narrow list) and words that say nothing in a name (broad list).
LEGAL = [r"\binc\.?(?=\s|$)", r"\bltd\.?(?=\s|$)", r"\bcorp\.?(?=\s|$)", r"\bllc\.?(?=\s|$)", r"\bplc\.?(?=\s|$)", r"\bgmbh(?=\s|$)", r"\bco\.(?=\s|$)", r"\blimited(?=\s|$)", r"\bcorporation(?=\s|$)", r"\bcompany(?=\s|$)"]
BROAD = (
    r"\b(?:inc\.?|ltd\.?|corp\.?|llc\.?|plc\.?|gmbh|co\.?|limited|corporation|company|technologies|labs?|ai|group|holdings?|ventures?|studios?|software|systems|platform"
    r"|networks?|solutions|services|international|global|digital)\b"
)
# Word characters, their borders and blanks as the reference's patterns have them, in any script.
_W = r"[\p{L}\p{N}_]"
_EDGE = rf"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"
SCHEMA_VERSION, PROMPT_VERSION = "1.0", 4


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BLANK + "+", " "))


def _any_script(p: str) -> str:
    return p.replace(r"\b", _EDGE).replace(r"\s", BLANK)


def sanitize_entity_name(c: Column) -> Column:
    """Lower case without legal suffixes, blanks collapsed, punctuation stripped at the edges."""
    x = F.trim(F.lower(c))
    for p in LEGAL:
        x = F.regexp_replace(x, _any_script(p), "")
    return F.trim(F.btrim(squeeze(x), F.lit(".,;:!?-—–")))


@F.pandas_udf(StringType())
def nfkd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def decomposed(c: Column) -> Column:
    """NFKD; plain ASCII stays in the JVM."""
    plain = c.rlike(r"^[\x00-\x7F]*$")
    return F.when(plain, c).otherwise(nfkd(F.when(plain, F.lit(None)).otherwise(c)))


def normalize_entity_name(c: Column, decompose: bool = True) -> Column:
    """Name for matching: NFKD, lower case, no parentheses, no suffix words anywhere, joiners as blanks, edges stripped."""
    x = F.trim(F.lower(decomposed(c) if decompose else c))
    x = F.regexp_replace(x, _any_script(r"\s*\([^\n]*?\)\s*"), " ")
    x = F.regexp_replace(F.regexp_replace(x, _any_script(BROAD), ""), r"[-–—_]+", " ")
    return F.btrim(squeeze(x), F.lit(".,;:!?-—–'\""))


def slug(c: Column, decompose: bool = True) -> Column:
    x = F.regexp_replace(F.regexp_replace(normalize_entity_name(c, decompose), r"\s+", "-"), r"[^a-z0-9-]", "")
    x = F.btrim(F.regexp_replace(x, r"-+", "-"), F.lit("-"))
    return F.when(x == "", "unknown").otherwise(x)


def canonical_id(name: Column, record_type: Column, decompose: bool = True) -> Column:
    t = F.regexp_replace(F.lower(record_type), "_", "-")
    return F.concat(F.when(t == "news-signal", "news").otherwise(t), F.lit("_"), slug(name, decompose))


def resolved_id(name: Column, record_type: Column) -> Column:
    """The resolver's identifier of a new entity; a name without letters or digits gets eight hash digits."""
    x = F.btrim(F.regexp_replace(F.lower(name), r"[^a-z0-9]+", "-"), F.lit("-"))
    return F.concat(F.lower(record_type), F.lit("_"), F.when(x == "", F.substring(F.sha2(F.coalesce(name, F.lit("")), 256), 1, 8)).otherwise(x))


def acronym(c: Column) -> Column:
    x = F.trim(c)
    return F.when(x.rlike(r"^\p{Lu}{1,6}$"), x)


def dedup_hash(url: Column, title: Column, source: Column) -> Column:
    from .urls import sanitize_url

    return F.sha2(F.concat_ws("|", F.lower(sanitize_url(url)), squeeze(F.lower(F.coalesce(title, F.lit("")))), F.coalesce(source, F.lit(""))), 256)


def content_hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def cache_key(content: Column, model: Column, record_type: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", content, F.lit(SCHEMA_VERSION), F.lit(str(PROMPT_VERSION)), model, record_type), 256), 1, 32)


def raw_key(source: Column, content: Column, ts: Column, name: str = "payload", ext: Column | None = None) -> Column:
    return F.concat(F.lit("raw/"), source, F.lit("/"), F.date_format(ts, "yyyy/MM/dd"), F.lit("/"), content, F.lit(f"/{name}."), F.lit("json") if ext is None else ext)


def extension(content_type: Column) -> Column:
    t = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(t.contains("json"), "json").when(t.contains("xml") & ~t.contains("html"), "xml").when(t.contains("pdf"), "pdf").otherwise("html")


def hash_of_key(key: Column) -> Column:
    p = F.split(key, "/")
    return F.when(F.size(p) >= 6, F.element_at(p, -2)).otherwise("")


def estimate_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(c) / 4)).cast("int")


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else html.unescape(x))


def sanitize_text(c: Column) -> Column:
    """Entities decoded (in Arrow batches, only texts that have some), control characters dropped, blanks and blank lines collapsed."""
    has = c.contains("&")
    x = F.when(has, _unescape(F.when(has, c))).otherwise(c)
    x = F.regexp_replace(x, r"[\x00-\x08\x0b-\x1f\x7f-\x9f]", "")
    return F.trim(F.regexp_replace(F.regexp_replace(x, r"[^\S\n]+", " "), r"\n{3,}", "\n\n"))


def parse_model_json(c: Column, schema: str) -> Column:
    """A model's answer as a struct: a code fence is stripped; else the widest braces, then brackets; unreadable: null."""
    x = F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```(?:json)?\s*", ""), r"\s*```$", ""))
    read = lambda t: F.from_json(t, schema)
    return F.coalesce(F.when(x.rlike(r"^\s*\{[\s\S]*\}\s*$"), read(x)), F.when(x.contains("{"), read(F.regexp_extract(x, r"(\{[\s\S]*\})", 1))))


