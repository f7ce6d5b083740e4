"""Best representative of each duplicate group, and currency reasoning for values without a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .components import says_something


def source_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s_-]+", "")


def score(c: Column) -> Column:
    """A score on 0..1: above 1 it is a percentage; missing or NaN is 0."""
    x = F.when(c.isNull() | F.isnan(c), F.lit(0.0)).otherwise(c)
    return F.when(x > 1, x / 100).otherwise(x)


def _ranked(rows: DataFrame, registry: DataFrame) -> DataFrame:
    reg = registry.select(source_key(F.col("source_name")).alias("sk"), "credibility").where("sk IS NOT NULL").groupBy("sk").agg(F.max(F.nanvl("credibility", F.lit(None).cast("double"))).alias("cred"))
    d = rows.select("entity_id", "field_name", "assertion_id", "value", score(F.col("grounding_score")).alias("g"), source_key(F.col("source_name")).alias("sk"), F.unix_micros(F.col("fetched_at").cast("timestamp")).alias("at"))
    return d.where("entity_id IS NOT NULL AND field_name IS NOT NULL").join(reg, "sk", "left").drop("sk").withColumn("said", says_something(F.col("value")))


def elect(rows: DataFrame, registry: DataFrame, least: int = 2) -> DataFrame:
    """``entity_id, field_name, assertion_id``: the surviving row of every entity and field with at least ``least`` rows.

    Rows whose value says nothing count as rows but cannot survive. The survivor has the highest grounding score, then the
    highest credibility, then the latest fetch time, then the smallest id; what is missing comes last. One aggregation with
    a minimum over a struct: a group of any size is pre-aggregated to one row a task.

    Defined cases: no row for groups without a value that says something, or with a null entity or field; repeated rows count
    as rows; an empty table gives an empty table; an unknown source has no credibility; other columns are ignored.
    """
    d = _ranked(rows, registry)
    best = F.min(
        F.when(
            F.col("said"),
            F.struct((-F.col("g")).alias("g"), F.col("cred").isNull().alias("c0"), (-F.col("cred")).alias("c"), F.col("at").isNull().alias("a0"), (-F.col("at")).alias("a"), F.col("assertion_id")),
        )
    )
    out = d.groupBy("entity_id", "field_name").agg(F.count(F.lit(1)).alias("n"), best.alias("k"))
    return out.where((F.col("n") >= least) & F.col("k").isNotNull()).select("entity_id", "field_name", "k.assertion_id")


#: Units of time in which changes are found: inside the first, between the first inside the second, and so on.
LEVELS = ("hour", "month")


def _changes(t: DataFrame) -> DataFrame:
    """``field_name, a, b``: each value with the next one of its group in time. ``t``: entity_id, field_name, at, nv (one row an instant).

    A window orders the instants of one unit of time only, the next level the first and last of each unit, so that no task
    orders a whole group.
    """
    from pyspark.sql import Window

    t = t.select("entity_id", "field_name", F.struct("at", "nv").alias("f"), F.struct("at", "nv").alias("l"))
    out = None
    for unit in (*LEVELS, None):
        by = ["entity_id", "field_name"]
        if unit:
            t = t.withColumn("unit", F.date_trunc(unit, F.timestamp_micros("f.at")))
            by.append("unit")
        step = t.select("field_name", F.lag("l.nv").over(Window.partitionBy(*by).orderBy("f.at")).alias("a"), F.col("f.nv").alias("b")).where("a IS NOT NULL")
        out = step if out is None else out.unionAll(step)
        t = t.groupBy(*by).agg(F.min("f").alias("f"), F.max("l").alias("l")).drop("unit")
    return out


def learn_precedence(d: DataFrame, min_support: int = 2) -> DataFrame:
    """``field_name, a, b, support``: values a that came before b clearly more often than after it, over all timestamped rows.

    ``d``: entity_id, field_name, nv (value), at. Instants at which a group has several values say nothing about their order
    and are left out.
    """
    t = d.where("at IS NOT NULL").groupBy("entity_id", "field_name", "at").agg(F.min("nv").alias("nv"), F.max("nv").alias("other")).where("nv = other")
    seen = _changes(t).where("a <> b")
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    n = seen.groupBy("field_name", lo.alias("x"), hi.alias("y")).agg(F.sum(F.when(F.col("a") == lo, 1).otherwise(-1)).alias("net"))
    return n.where(F.abs("net") >= min_support).select(
        "field_name", F.when(F.col("net") > 0, F.col("x")).otherwise(F.col("y")).alias("a"), F.when(F.col("net") > 0, F.col("y")).otherwise(F.col("x")).alias("b"), F.abs("net").alias("support")
    )


def reachable(step: DataFrame, starts: DataFrame) -> DataFrame:
    """``field_name, a, b``: everything that the steps (field_name, a, b) lead to, over any number of them, from the ``starts`` (field_name, a).

    Only pairs found last are carried on, one join with the steps a round.
    """
    edge = step.select("field_name", F.col("a").alias("b"), F.col("b").alias("c"))
    new = stage(step.join(starts, ["field_name", "a"], "left_semi").select("field_name", "a", "b").distinct(), "order-new")
    seen = new
    while not new.isEmpty():
        nxt = new.join(edge, ["field_name", "b"]).select("field_name", "a", F.col("c").alias("b")).distinct()
        new = stage(nxt.join(seen, ["field_name", "a", "b"], "left_anti"), "order-new")
        seen = seen.unionAll(new)
    return seen


def elect_current(rows: DataFrame, registry: DataFrame, min_support: int = 2) -> DataFrame:
    """``entity_id, field_name, assertion_id, value, inferred``: the most current row of each group in which some row has no timestamp.

    The learned precedence, over any number of values between, gives each group a partial order of its values. Values that
    a value of the same group is known to follow are out of date; among the rest, the topologically latest, the latest
    timestamp, then the score, credibility and smallest id decide. ``inferred``: whether the order ruled out some value.

    Defined cases: values that follow each other in a ring do not rule each other out; otherwise as for :func:`elect`.
    """
    d = stage(_ranked(rows, registry).where("said").withColumn("nv", F.lower(F.regexp_replace(F.trim("value"), r"\s+", " "))), "assertions")
    p = stage(learn_precedence(d, min_support), "precedence")
    need = d.groupBy("entity_id", "field_name").agg(F.bool_or(F.col("at").isNull()).alias("open"), F.count(F.lit(1)).alias("n")).where("open AND n > 1").select("entity_id", "field_name")
    g = stage(d.join(need, ["entity_id", "field_name"], "left_semi"), "open-groups")
    values = g.select("entity_id", "field_name", "nv").distinct()
    order = reachable(p, values.select("field_name", F.col("nv").alias("a")).distinct())
    # of values in a ring each leads to the other: neither is later
    ring = reachable(p, order.select("field_name", F.col("b").alias("a")).distinct()).select("field_name", F.col("b").alias("a"), F.col("a").alias("b"))
    order = order.where("a <> b").join(ring, ["field_name", "a", "b"], "left_anti")
    later = values.select("entity_id", "field_name", F.col("nv").alias("a")).join(order, ["field_name", "a"]).join(values.select("entity_id", "field_name", F.col("nv").alias("b")), ["entity_id", "field_name", "b"], "left_semi")
    old = later.select("entity_id", "field_name", F.col("a").alias("nv"), F.lit(True).alias("old")).distinct()
    g = g.join(old, ["entity_id", "field_name", "nv"], "left")
    key = F.struct(
        F.coalesce("old", F.lit(False)).alias("o"), F.col("at").isNull().alias("a0"), (-F.col("at")).alias("a"), (-F.col("g")).alias("g"),
        F.col("cred").isNull().alias("c0"), (-F.col("cred")).alias("c"), F.col("assertion_id"), F.col("value"),
    )
    best = g.groupBy("entity_id", "field_name").agg(F.min(key).alias("k"), F.coalesce(F.bool_or("old"), F.lit(False)).alias("inferred"))
    return best.select("entity_id", "field_name", "k.assertion_id", "k.value", "inferred")
