"""Queue semantics on tables: message codec, claims of stale messages, retries, back-pressure, provider fallback, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def encode(df: DataFrame, out: str = "data") -> DataFrame:
    """Every row as one JSON text, nulls left out."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(out))


def decode(df: DataFrame, schema: str, data: str = "data") -> DataFrame:
    """The messages of JSON texts (or their UTF-8 bytes); text that is no message gives a row of nulls in ``schema``."""
    c = F.col(f"`{data}`").cast("string")
    return df.select(F.from_json(c, schema).alias("m")).select("m.*")


def claim_stale(pending: DataFrame, now: Column, idle_ms: int = 300_000, seen_at: str = "received_at", attempt: str = "attempt", most: str = "max_attempts") -> DataFrame:
    """``pending`` plus idle_ms, claimed, next_attempt and route (wait, retry, dead_letter).

    A message idle for ``idle_ms`` or longer is claimed and counts one attempt more, in the data, so the count survives a
    restart; with its last attempt used up it goes to the dead letters. A message never seen is not idle.
    """
    idle = F.floor((F.unix_micros(now) - F.unix_micros(F.col(seen_at).cast("timestamp"))) / 1000)
    claimed = F.coalesce(idle >= idle_ms, F.lit(False))
    nxt = F.coalesce(F.col(attempt), F.lit(0)) + claimed.cast("int")
    route = F.when(~claimed, "wait").when(nxt >= F.coalesce(F.col(most), F.lit(5)), "dead_letter").otherwise("retry")
    return pending.withColumn("idle_ms", idle).withColumn("claimed", claimed).withColumn("next_attempt", nxt).withColumn("route", route)


def queue_depth(messages: DataFrame, stream: str, high: int = 10_000, low: int = 5_000) -> DataFrame:
    """``stream, depth, pressure``: hold above the high mark, release below the low one, steady between."""
    d = messages.groupBy(stream).agg(F.count(F.lit(1)).alias("depth"))
    return d.withColumn("pressure", F.when(F.col("depth") >= high, "hold").when(F.col("depth") <= low, "release").otherwise("steady"))


def hold_seconds(tries: Column, most: float = 30.0) -> Column:
    """Seconds a producer sleeps under back-pressure, before jitter."""
    return F.least(F.pow(F.lit(2.0), tries), F.lit(most))


def choose_provider(requests: DataFrame, providers: DataFrame, mode: str = "mode") -> DataFrame:
    """``requests`` plus provider: the first one in order whose breaker is not open; when saving costs only the first counts.

    ``providers`` (provider, pos, state, kind), per ``kind`` of request if that column is there; a short table, aggregated to
    one row a kind before it is joined. No provider: null.
    """
    by = ["kind"] if "kind" in providers.columns else []
    usable = F.col("state") != "OPEN"
    first = F.min_by("provider", "pos")
    p = providers.groupBy(*by).agg(F.min_by(F.when(usable, F.col("provider")), F.struct((~usable).alias("o"), "pos")).alias("any_provider"), F.when(F.min_by(usable, "pos"), first).alias("cheap_provider"))
    joined = requests.join(p, by, "left") if by else requests.join(p, F.lit(True), "left")
    return joined.withColumn("provider", F.when(F.col(mode) == "saving", F.col("cheap_provider")).otherwise(F.col("any_provider"))).drop("any_provider", "cheap_provider")


def batches(df: DataFrame, group: str, order: list[str], size: int = 500) -> DataFrame:
    """``df`` plus batch: consecutive batches of ``size`` rows of each group, numbered from 0.

    Rows are numbered in two levels, inside blocks of a hash and over the blocks' counts, so no task orders a whole group: rows
    of a block come together, in their order.
    """
    b = F.pmod(F.xxhash64(*order), F.lit(256))
    d = df.withColumn("__b", b).withColumn("__r", F.row_number().over(Window.partitionBy(group, "__b").orderBy(*order)) - 1)
    n = df.withColumn("__b", b).groupBy(group, "__b").agg(F.count(F.lit(1)).alias("__n"))
    n = n.withColumn("__o", F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    return d.join(n, [group, "__b"]).withColumn("batch", F.floor((F.col("__o") + F.col("__r")) / size)).drop("__b", "__r", "__o")


def throttle(df: DataFrame, key: str, at: str, order: str, rates: DataFrame | None = None, rate: float = 1.0) -> DataFrame:
    """``df`` plus wait: seconds until each request of a ``key`` may go, under a token bucket of its rate that holds max(rate, 1) tokens.

    ``rates`` (key, rate) overrides the rate of single keys. A request waits for (i + 1 - capacity) / rate after the latest
    start that binds it, the largest of t_j - j / rate so far, so the recursion is a running maximum. It is taken in two
    levels, inside hours and over a key's hours, so no task orders a whole key. A null time or key waits 0.
    """
    d = df.withColumn("__t", F.unix_micros(F.col(at).cast("timestamp")) / 1e6).withColumn("__u", F.floor(F.col("__t") / 3600))
    d = d.join(rates.select(F.col(key), F.col("rate").alias("__own")), key, "left") if rates is not None else d.withColumn("__own", F.lit(None).cast("double"))
    d = d.withColumn("__rate", F.coalesce("__own", F.lit(float(rate))))
    w = Window.partitionBy(key, "__u").orderBy("__t", order)
    d = d.withColumn("__j", F.row_number().over(w) - 1)
    gap = F.col("__t") - F.col("__j") / F.col("__rate")
    hours = d.where("__t IS NOT NULL").groupBy(key, "__u").agg(F.count(F.lit(1)).alias("__n"), F.max(gap).alias("__m"), F.first("__rate").alias("__r"))
    past = Window.partitionBy(key).orderBy("__u").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.withColumn("__o", F.coalesce(F.sum("__n").over(past), F.lit(0)))
    hours = hours.withColumn("__p", F.max(F.col("__m") - F.col("__o") / F.col("__r")).over(past)).select(key, "__u", "__o", "__p")
    d = d.join(hours, [key, "__u"], "left")
    here = F.max(gap).over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__o") / F.col("__rate")
    cap = F.greatest(F.col("__rate"), F.lit(1.0))
    start = F.greatest(here, F.col("__p")) + (F.col("__o") + F.col("__j") + 1 - cap) / F.col("__rate")
    return d.withColumn("wait", F.coalesce(F.round(F.greatest(F.lit(0.0), start - F.col("__t")), 6), F.lit(0.0))).drop("__t", "__u", "__own", "__rate", "__j", "__o", "__p")


def sliding_window(df: DataFrame, key: str, at: str, width_s: int = 60, most: int = 12) -> DataFrame:
    """``df`` plus in_window, the requests of its key in the last ``width_s`` seconds (its own included), and admitted.

    Requests are counted in blocks of the window's width, so a task orders one block and the one before it, never a whole key.
    """
    width = width_s * 1_000_000
    d = df.withColumn("__t", F.unix_micros(F.col(at).cast("timestamp"))).withColumn("__b", F.floor(F.col("__t") / width)).withColumn("__own", F.lit(True))
    both = d.unionByName(d.withColumn("__b", F.col("__b") + 1).withColumn("__own", F.lit(False)))
    w = Window.partitionBy(key, "__b").orderBy("__t").rangeBetween(-width, 0)
    out = both.withColumn("in_window", F.count(F.lit(1)).over(w)).where("__own").drop("__t", "__b", "__own")
    return out.withColumn("admitted", F.col("in_window") <= most)
