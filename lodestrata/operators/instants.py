"""Mixed timestamp texts normalised to one UTC instant.

Every format is one alternative of a single regular expression with named groups. A text is matched once; its components go
into integer columns; calendar ranges are checked and the instants assembled by integer day arithmetic on whole columns.
Only wall times without an own offset ask the zone database, once per distinct zone and wall minute in a batch.
"""

from __future__ import annotations

import re
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names by language, zone abbreviations in minutes east of UTC.
_MONTHS = (
    "january february march april may june july august september october november december",
    "jan feb mar apr may jun jul aug sep oct nov dec",
    "januar februar märz april mai juni juli august september oktober november dezember",
    "jänner feber maerz apr mai jun jul aug sept okt nov dez",
    "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "janv fevrier mars avr mai juin juil aout sept oct nov decembre",
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
    "ene feb mar abr may jun jul ago set oct nov dic",
)
MONTHS = {n: i + 1 for row in _MONTHS for i, n in enumerate(row.split())} | {"févr": 2, "déc": 12, "mär": 3}
ZONES = {
    "z": 0, "utc": 0, "gmt": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120, "eet": 120, "eest": 180, "msk": 180,
    "ist": 330, "sgt": 480, "hkt": 480, "awst": 480, "jst": 540, "kst": 540, "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600,
}
_UNIT_US = {"second": 10**6, "sec": 10**6, "minute": 60 * 10**6, "min": 60 * 10**6, "hour": 3600 * 10**6, "hr": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}
_SAID = {"a": 1, "an": 1, "one": 1}

_MON = "(?P<mon>" + "|".join(sorted(MONTHS, key=len, reverse=True)) + r")\.?"
_WD = r"(?:[^\W\d_]{2,12}\.?,?\s+)"
_OFF = r"(?P<off>[+-]\d{2}:?\d{2}|[+-]\d{1,2})"
_ABB = "(?P<abb>" + "|".join(sorted(ZONES, key=len, reverse=True)) + r")(?![a-z])"
_ZONE = rf"(?:{_OFF}|{_ABB}(?:\s*(?P<plus>[+-]\d{{1,2}}(?::?\d{{2}})?))?)"
_HMS = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,](?P<fr>\d+))?)?"
_AP = r"(?:\s*(?P<ap>[ap]\.?m\.?))"

#: name: pattern. Group names get the format's number, as one expression can use a name only once.
FORMATS = {
    "iso": rf"(?P<y>\d{{4}})-(?P<mo>\d{{1,2}})-(?P<d>\d{{1,2}})(?:(?:T|\s+){_HMS}{_AP}?\s*{_ZONE}?(?:\[(?P<iana>[\w/+-]+)\])?)?",
    "compact": r"(?P<y>\d{4})(?P<mo>\d{2})(?P<d>\d{2})(?:T?(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})?(?:[.,](?P<fr>\d+))?\s*" + _ZONE + "?)?(?!\\d)",
    "epoch_s": r"(?P<es>\d{9,10})(?:\.(?P<fr>\d+))?",
    "epoch_ms": r"(?P<ems>\d{12,13})",
    "epoch_us": r"(?P<eus>\d{15,16})",
    "epoch_ns": r"(?P<ens>\d{18,19})",
    "day_month": rf"{_WD}?(?P<d>\d{{1,2}})(?:st|nd|rd|th|er|º)?\.?\s*(?:de\s+)?{_MON}\s*(?:de\s+)?(?P<y>\d{{4}})(?:,?\s+(?:(?:um|at|à|a las)\s+)?(?P<h>\d{{1,2}})\s?[:h](?P<mi>\d{{2}})(?::(?P<s>\d{{2}})(?:[.,](?P<fr>\d+))?)?{_AP}?(?:\s*uhr)?\s*{_ZONE}?)?",
    "rfc850": rf"{_WD}?(?P<d>\d{{1,2}})-{_MON}-(?P<y>\d{{4}}|\d{{2}})\s+{_HMS}\s*{_ZONE}?",
    "asctime": rf"{_WD}?{_MON}\s+(?P<d>\d{{1,2}})\s+{_HMS}\s*(?:{_ZONE}\s+)?(?P<y>\d{{4}})",
    "month_day": rf"{_WD}?{_MON}\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})(?:,?\s+(?:at\s+)?{_HMS}{_AP}?\s*{_ZONE}?)?",
    "dotted": rf"(?P<d>\d{{1,2}})\.\s?(?P<mo>\d{{1,2}})\.\s?(?P<y>\d{{4}})(?:,?\s+(?:um\s+)?{_HMS}{_AP}?(?:\s*uhr)?\s*{_ZONE}?)?",
    "slashed": rf"(?P<p>\d{{1,2}})/(?P<q>\d{{1,2}})/(?P<y>\d{{4}})(?:,?\s+(?:at\s+)?{_HMS}{_AP}?\s*{_ZONE}?)?",
    "slashed_y": rf"(?P<y>\d{{4}})/(?P<mo>\d{{1,2}})/(?P<d>\d{{1,2}})(?:,?\s+{_HMS}{_AP}?\s*{_ZONE}?)?",
    "ago": r"(?:(?:about|around|approximately|approx\.?|ca\.?|~)\s*)?(?P<n>\d{1,9}|an?|one)\s+(?P<u>" + "|".join(sorted(_UNIT_US, key=len, reverse=True)) + r")s?\.?\s+ago",
}
_NAMES = list(FORMATS)
_LABEL = r"(?:(?:published|posted|updated|modified|created|date|stand|veröffentlicht|aktualisiert|publié|mis à jour|publicado|actualizado|last updated|last modified|last update)(?:\s+(?:on|at|am|le|el))?\s*:?\s*)?"


def _alternation() -> re.Pattern:
    parts = [f"(?P<f{i}>" + re.sub(r"\(\?P<(\w+)>", lambda m, i=i: f"(?P<f{i}_{m[1]}>", FORMATS[n]) + ")" for i, n in enumerate(_NAMES)]
    return re.compile(r"\s*" + _LABEL + "(?:" + "|".join(f"{p}(?=\\s*\\Z)" for p in parts) + r")\s*\Z", re.I)


_RE = _alternation()
#: Of each format, the names of its parts and their groups.
_PARTS = [[(name.split("_", 1)[1], at) for name, at in _RE.groupindex.items() if name.startswith(f"f{i}_")] for i in range(len(_NAMES))]
_BLANKS = re.compile(r"\s{3,}")


def _civil_days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Days since 1970-01-01 in the proleptic Gregorian calendar."""
    y = y - (m <= 2)
    era = y // 400
    yoe = y - era * 400
    doy = (153 * (m + np.where(m > 2, -3, 9)) + 2) // 5 + d - 1
    return era * 146097 + yoe * 365 + yoe // 4 - yoe // 100 + doy - 719468


def _minutes(s: str) -> int:
    sign, x = (-1 if s[0] == "-" else 1), s[1:].replace(":", "")
    h, m = (int(x), 0) if len(x) <= 2 else (int(x[:-2]), int(x[-2:]))
    return sign * (h * 60 + m) if h <= 18 and m < 60 else 10**6


def _offsets(zone: str, days: np.ndarray, mins: np.ndarray, date_only: np.ndarray) -> np.ndarray:
    """Minutes east of UTC of wall times in ``zone``; 10**6 where the wall time occurs twice or never."""
    import datetime as dt

    out = np.full(len(days), 10**6, np.int64)
    try:
        z = ZoneInfo(zone)
    except Exception:
        return out
    key = days * 1440 + mins
    u, back = np.unique(key, return_inverse=True)
    first, clear = np.empty(len(u), np.int64), np.empty(len(u), bool)
    epoch = dt.datetime(1970, 1, 1)
    for i, k in enumerate(u):
        w = epoch + dt.timedelta(minutes=int(k))
        try:
            a, b = z.utcoffset(w.replace(fold=0)), z.utcoffset(w.replace(fold=1))
        except OverflowError:
            first[i], clear[i] = 10**6, True
            continue
        first[i], clear[i] = a.days * 1440 + a.seconds // 60, a == b
    return np.where(clear[back] | date_only, first[back], 10**6)


def parse_batch(raw: list, zones: list, orders: list, fetched: list) -> list[int | None]:
    """Microseconds since 1970 UTC of each text, or None. ``fetched``: microseconds or None."""
    n = len(raw)
    I = lambda: np.zeros(n, np.int64)  # noqa: E731, E741
    y, mo, d, h, mi, s, us, off = I(), I(), I(), I(), I(), I(), I(), I()
    kind = np.zeros(n, np.int8)  # 0 nothing, 1 civil, 2 direct
    local, dated, direct = np.zeros(n, bool), np.zeros(n, bool), I()
    bad = np.zeros(n, bool)
    for i, t in enumerate(raw):
        if t is None:
            continue
        # formats tell no more than one blank from several; long runs would be tried at every length
        m = _RE.match(t if len(t) < 100 else _BLANKS.sub("  ", t))
        if not m:
            continue
        k = next(j for j in range(len(_NAMES)) if m[f"f{j}"] is not None) if m.lastgroup is None or "_" in m.lastgroup else int(m.lastgroup[1:])
        name = _NAMES[k]
        g = {a: b for a, at in _PARTS[k] if (b := m[at]) is not None}
        if name.startswith("epoch"):
            kind[i] = 2
            direct[i] = (
                int(g["es"]) * 10**6 + int((g.get("fr", "") + "000000")[:6]) if "es" in g else int(g["ems"]) * 1000 if "ems" in g else int(g["eus"]) if "eus" in g else int(g["ens"]) // 1000
            )
            continue
        if name == "ago":
            if fetched[i] is not None:
                kind[i], direct[i] = 2, fetched[i] - (_SAID.get(g["n"].lower()) or int(g["n"])) * _UNIT_US[g["u"].lower()]
            continue
        kind[i] = 1
        if "p" in g:
            o = orders[i]
            if o not in ("dmy", "mdy"):
                bad[i] = True
                continue
            a, b = int(g["p"]), int(g["q"])
            d[i], mo[i] = (a, b) if o == "dmy" else (b, a)
        else:
            d[i], mo[i] = int(g["d"]), int(g["mo"]) if "mo" in g else MONTHS[g["mon"].lower()]
        yy = g["y"]
        y[i] = int(yy) if len(yy) == 4 else int(yy) + (2000 if int(yy) < 70 else 1900)
        if "h" in g:
            hh = int(g["h"])
            if "ap" in g:
                if not 1 <= hh <= 12:
                    bad[i] = True
                hh = hh % 12 + (12 if g["ap"][0] in "pP" else 0)
            h[i], mi[i], s[i] = hh, int(g["mi"]), int(g.get("s", 0))
            us[i] = int((g.get("fr", "") + "000000")[:6])
        else:
            dated[i] = True
        if "off" in g:
            off[i] = _minutes(g["off"])
        elif "abb" in g:
            off[i] = ZONES[g["abb"].lower()] + (_minutes(g["plus"]) if "plus" in g else 0)
        else:
            local[i] = True
            if "iana" in g:
                zones[i] = g["iana"]
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    last = np.array([0, 31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[np.clip(mo, 0, 12)] + (leap & (mo == 2))
    ok = (kind == 1) & ~bad & (y >= 1) & (mo >= 1) & (mo <= 12) & (d >= 1) & (d <= last) & (h <= 23) & (mi <= 59) & (s <= 59)
    days = _civil_days(y, np.maximum(mo, 1), d)
    at: dict = {}
    for i in np.flatnonzero(ok & local):
        at.setdefault(zones[i], []).append(i)
    for zone, rows in at.items():
        r = np.array(rows)
        off[r] = _offsets(zone, days[r], h[r] * 60 + mi[r], dated[r]) if isinstance(zone, str) and zone else 10**6
    ok &= np.abs(off) <= 18 * 60
    total = ((days * 1440 + h * 60 + mi - off) * 60 + s) * 10**6 + us
    return [int(total[i]) if ok[i] else int(direct[i]) if kind[i] == 2 else None for i in range(n)]


def source_key(c: Column) -> Column:
    """Source names agree apart from case, outer blanks and blank/``-``/``_``."""
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s_-]+", "")


def to_instants(df: DataFrame, keys: list[str], text: str, zone: str | None = None, order: str | None = None, fetched_at: str | None = None, out: str = "utc_us") -> DataFrame:
    """``keys`` and ``out``: one row per text that states exactly one instant, in microseconds since 1970 UTC, cut to microseconds.

    ``zone``: column with the IANA zone of wall times without one; ``order``: column with ``dmy``/``mdy`` for slashed dates;
    ``fetched_at``: column that relative times count back from (a day is 24 h).

    Defined cases: no row for null, blank, other text, impossible calendar values, a needed zone/order/fetch time that is null
    or unknown, and wall times that occur twice or never; a date alone is its first moment in the zone; texts of any length are
    read whole; repeated rows give repeated rows; an empty table gives an empty table; other columns are ignored.
    """
    if out.lower() in {k.lower() for k in keys}:
        raise ValueError("out needs a name that no key has")
    null = F.lit(None)
    d = df.select(
        *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], F.col(f"`{text}`").cast("string").alias("raw"),
        (F.col(f"`{zone}`") if zone else null).cast("string").alias("tz"), F.lower(F.col(f"`{order}`") if order else null.cast("string")).alias("ord"),
        (F.unix_micros(F.col(f"`{fetched_at}`").cast("timestamp")) if fetched_at else null.cast("long")).alias("at"),
    ).where("raw RLIKE '[0-9a-zA-Z]'")
    ks = [f"k{i}" for i in range(len(keys))]

    def run(batches):
        for b in batches:
            v = parse_batch(b["raw"].tolist(), b["tz"].tolist(), b["ord"].tolist(), [None if pd.isna(x) else int(x) for x in b["at"]])
            keep = [i for i, x in enumerate(v) if x is not None]
            o = b.iloc[keep][ks].copy()
            o["us"] = np.array([v[i] for i in keep], dtype=np.int64)
            yield o

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField(f.name, f.dataType) for f in d.schema.fields[: len(keys)]] + [StructField("us", LongType())])
    return d.mapInPandas(run, schema).toDF(*keys, out)
