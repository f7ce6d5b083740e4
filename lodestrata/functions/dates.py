"""Dates written inside texts, and whether one of them is near a claimed date, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTH = r"(?:January|February|March|April|May|June|July|August|September|October|November|December)"
#: Pattern and format of each way of writing a date, strictest first.
WRITTEN = (
    (r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"),
    (rf"({_MONTH} \d{{1,2}}, \d{{4}})", "MMMM d, yyyy"),
    (rf"(\d{{1,2}} {_MONTH} \d{{4}})", "d MMMM yyyy"),
    (rf"({_MONTH} \d{{1,2}} \d{{4}})", "MMMM d yyyy"),
)


def _at(c: Column, fmt: str) -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit(fmt)))


def dates_in(c: Column) -> Column:
    """array<date> of the calendar dates in a text, by way of writing; there is no year 0."""

    def one(pattern: str, fmt: str) -> Column:
        return F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), lambda x: _at(x, fmt))

    return F.filter(F.concat(*[one(p, f) for p, f in WRITTEN]), lambda x: F.year(x) > 0)


def first_date(c: Column) -> Column:
    return F.get(dates_in(c), F.lit(0))


def date_score(claimed: Column, text: Column) -> Column:
    """1 for a date of the text on the same day, 0 for one a day off (still grounded), null where none is within a day."""
    near = F.filter(F.transform(dates_in(text), lambda d: F.abs(F.datediff(d, claimed))), lambda n: n <= 1)
    return F.when(F.size(near) > 0, (1 - F.array_min(near)).cast("double"))


# Seconds of the units of relative dates, in order of precedence; a month has 30 days, a year 365.
AGO = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800, "month": 2592000, "year": 31536000}


def relative_date(c: Column, now: Column) -> Column:
    """Timestamp that "3 weeks ago", "yesterday", "today" or "just now" means at ``now``; null for other texts. The first unit in order wins."""
    back = F.lit(None).cast("long")
    for unit, seconds in reversed(AGO.items()):
        n = F.regexp_extract(c, rf"(?i)(\d+)\s*{unit}s?\s*ago", 1).try_cast("long")
        back = F.when(n.isNotNull(), n * seconds).otherwise(back)
    word = F.when(c.rlike(r"(?i)\byesterday\b"), 86400).when(c.rlike(r"(?i)\btoday\b|\bjust\s*now\b"), 0).cast("long")
    return F.timestamp_micros(F.unix_micros(now.cast("timestamp")) - F.coalesce(back, word) * 1_000_000)


#: Formats of whole texts that are read strictly, after ISO ones.
STRICT = ("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "d MMM yyyy HH:mm:ss z", "MMMM d, yyyy", "d MMMM yyyy", "MMM d, yyyy", "d MMM yyyy")


def layered_date(c: Column, now: Column) -> Column:
    """struct<value, confidence, layer>: strictly by format, else heuristically by a relative phrase, else by a date somewhere in
    the text; null if nothing is stated. Texts without zone are UTC."""
    x = F.trim(c)
    bare = F.regexp_replace(x, r"^[A-Za-z]{3,9},\s+", "")  # a weekday says nothing more
    strict = F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in STRICT])
    told, loose = relative_date(x, now), first_date(x).cast("timestamp")
    one = lambda v, sure, layer: F.struct(v.alias("value"), F.lit(sure).alias("confidence"), F.lit(layer).alias("layer"))
    return F.when(strict.isNotNull(), one(strict, "strict", "format")).when(told.isNotNull(), one(told, "heuristic", "relative")).when(loose.isNotNull(), one(loose, "heuristic", "text"))


def within_hours(ts: Column, now: str, hours: float) -> Column:
    """Not older than so many hours at ``now``."""
    return F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(ts.cast("timestamp")) <= hours * 3600e6
