"""Crawl policies as data: robots rules, waits after failures, token buckets, proxy choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import extract_domain


def robots_allowed(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` plus allowed: the longest rule path that is a prefix of the URL's path decides; none, or no rules, allows.

    ``rules``: host, path, allow.
    """
    d = urls.withColumn("__host", extract_domain(F.col(url))).withColumn("__path", F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*([^#]*)", 1)).withColumn("__id", F.monotonically_increasing_id())
    hit = d.select("__id", "__host", "__path").join(rules.select(F.col("host").alias("__host"), "path", "allow"), "__host").where("path <> '' AND startswith(__path, path)")
    best = hit.groupBy("__id").agg(F.max_by("allow", F.struct(F.length("path"), F.col("allow"))).alias("allowed"))
    return d.join(best, "__id", "left").withColumn("allowed", F.coalesce("allowed", F.lit(True))).drop("__id", "__host", "__path")


def retry_wait(attempt: Column, retry_after: Column) -> Column:
    """Seconds to wait after a 429: what the answer says, else 2^attempt, at most 60."""
    return F.least(F.lit(60.0), F.coalesce(retry_after.cast("double"), F.pow(F.lit(2.0), attempt)))


def response_class(status: Column) -> Column:
    return F.when(status.between(200, 399), "ok").when(status == 429, "rate_limited").when(status.between(500, 599), "server_error").otherwise("failed")


def token_bucket(times: list[float], rate: float) -> list[float]:
    """Waiting time of each request of one domain under a bucket that holds max(rate, 1) tokens."""
    cap = max(rate, 1.0)
    tokens, last, out = cap, None, []
    for t in times:
        if last is not None:
            tokens = min(cap, tokens + max(0.0, t - last) * rate)
        wait = 0.0 if tokens >= 1 else (1 - tokens) / rate
        tokens = tokens + wait * rate - 1
        last = t + wait
        out.append(wait)
    return out


def best_proxies(stats: DataFrame, top: int = 3) -> DataFrame:
    """The ``top`` proxies of each domain by success rate (1.0 when unused), a report; those under 0.3 are rotated out."""
    total = F.col("success") + F.col("failure")
    d = stats.withColumn("success_rate", F.round(F.when(total > 0, F.col("success") / total).otherwise(1.0), 2)).where("success_rate >= 0.3")
    return d.withColumn("rank", F.row_number().over(Window.partitionBy("domain").orderBy(F.desc("success_rate"), "proxy"))).where(F.col("rank") <= top)
