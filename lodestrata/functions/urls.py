"""URL columns in one canonical spelling, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track visitors.
TRACKING_SHORT = "utm_source utm_medium utm_campaign utm_term utm_content fbclid gclid ref source".split()
TRACKING = [*TRACKING_SHORT, "mc_cid", "mc_eid", "s_cid", "trk"]

_SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*):"
# scheme, host without www., path without parameters of its last segment, query
_WHOLE = r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?(?://(?:[wW]{3}\.)?([^/?#]*))?((?:[^?#;/]*/)*[^?#;/]*)(?:;[^?#/]*)?(?:\?([^#]*))?(?:#[\s\S]*)?$"


def _parts(u: Column) -> dict[str, Column]:
    """Scheme, host (with port), path and query, from one pass of one expression."""
    cut = F.split(F.regexp_replace(u, _WHOLE, "$1\u0001$2\u0001$3\u0001$4"), "\u0001")
    return {"scheme": F.lower(F.get(cut, F.lit(0))), "host": F.lower(F.coalesce(F.get(cut, F.lit(1)), F.lit(""))), "path": F.coalesce(F.get(cut, F.lit(2)), F.lit("")), "query": F.coalesce(F.get(cut, F.lit(3)), F.lit(""))}


def _join(scheme: Column, p: dict[str, Column], path: Column, params: Column) -> Column:
    query = F.array_join(params, "&")
    slash = F.when((p["host"] != "") & (path != "") & ~path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")), F.when(p["host"] != "", F.concat(F.lit("//"), p["host"])).otherwise(F.lit("")), slash, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def _kept(query: Column, drop: list[str]) -> Column:
    empty = F.array().cast("array<string>")
    return F.when(query == "", empty).otherwise(F.filter(F.split(query, "&"), lambda x: ~F.lower(F.split(x, "=").getItem(0)).isin(*drop)))


def normalize_url(u: Column, base: Column | None = None, keep_scheme: bool = True) -> Column:
    """Canonical URL: lower-case scheme (default https) and host without ``www.``, no trailing slash but the root's, no fragment,
    parameters sorted and without tracking keys. A null or empty URL gives "". With ``base``, a URL that starts with a slash is
    put on the base's host, any other one without http(s) beside the base's last path segment."""
    if base is not None:
        b = _parts(base)
        origin = F.concat(b["scheme"], F.lit("://"), F.lower(F.regexp_extract(base, r"^[^:]*://([^/?#]*)", 1)))
        folder = F.concat(F.regexp_replace(b["path"], r"[^/]*$", ""))
        full = F.when(u.startswith("//"), F.concat(b["scheme"], F.lit(":"), u)).when(u.startswith("/"), F.concat(origin, u)).otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), u))
        u = F.when(u.rlike(r"^https?://") | u.rlike(_SCHEME) | (u == ""), u).otherwise(full)
    cut = F.split(F.regexp_replace(u, _WHOLE, "$1\u0001$2\u0001$3\u0001$4"), "\u0001")

    def build(c):
        at = lambda i: F.coalesce(F.get(c, F.lit(i)), F.lit(""))
        p = {"host": F.lower(at(1)), "path": at(2), "query": at(3)}
        path = F.when((p["path"] == "/") | ~p["path"].endswith("/"), p["path"]).otherwise(F.rtrim(p["path"], F.lit("/")))
        scheme = F.when(at(0) == "", F.lit("https")).otherwise(F.lower(at(0))) if keep_scheme else F.lit("")
        return _join(scheme, p, path, F.array_sort(_kept(p["query"], TRACKING)))

    # the parts are bound once and used several times
    return F.when(u.isNull() | (u == ""), F.lit("")).otherwise(F.get(F.transform(F.array(cut), build), F.lit(0)))


def sanitize_url(u: Column) -> Column:
    """Canonical URL for storage: https, no tracking keys (order kept), no trailing slash at all, no fragment."""
    t = F.trim(u)
    p = _parts(t)
    scheme = F.when(p["scheme"].isin("http", "https", ""), F.lit("https")).otherwise(p["scheme"])
    return F.when(u.isNull() | (u == ""), F.lit("")).otherwise(_join(scheme, p, F.regexp_replace(p["path"], r"/+$", ""), _kept(p["query"], TRACKING_SHORT)))


def extract_domain(u: Column) -> Column:
    return _parts(u)["host"]


def owner_repo(u: Column) -> Column:
    """The first two path segments as ``owner/repo``; "" where there are fewer."""
    seg = F.filter(F.split(_parts(u)["path"], "/"), lambda x: x != "")
    return F.when(F.size(seg) >= 2, F.concat_ws("/", seg.getItem(0), seg.getItem(1))).otherwise(F.lit(""))
