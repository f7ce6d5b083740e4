"""Verification of single fields by class, and the verdict on a record.

Every verifier takes columns and gives a struct (status, score): a value that is none is MISSING, one that the texts do not
bear out UNVERIFIED, else GROUNDED. Only partial ratios leave the JVM, and only for texts that do not contain each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_score, first_date
from ..functions.similarity import partial_ratio_udf
from ..functions.urls import sanitize_url
from .grounding import all_numbers, classify_field, first_number


def _result(status: Column, score: Column) -> Column:
    return F.struct(status.alias("status"), score.cast("double").alias("score"))


def _blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def likeness(needle: Column, text: Column) -> Column:
    """Partial ratio of two texts in small letters, 0..100; 100 without a look at Python where the text contains the needle."""
    a, b = F.lower(F.trim(needle)), F.lower(text)
    inside = F.coalesce(F.contains(b, a), F.lit(False))
    return F.when(inside, 100.0).otherwise(F.coalesce(partial_ratio_udf(F.when(~inside, a), F.when(~inside, b)), F.lit(0.0)))


def verify_texts(d: DataFrame, value: str = "value", evidence: str = "evidence", source: str = "source", threshold: float = 90.0, out: str = "text_result") -> DataFrame:
    """``d`` plus ``out``: the evidence must be in the source, then the value in the evidence; without evidence the value in the source."""
    v, e, s = F.col(value), F.col(evidence), F.col(source)
    bare = _blank(e)
    d = d.withColumn("__first", likeness(F.when(_blank(v), None).when(bare, v).otherwise(e), s))
    more = ~_blank(v) & ~bare & (F.col("__first") >= threshold)
    d = d.withColumn("__second", likeness(F.when(more, v), F.when(more, e)))
    score = F.when(more, F.col("__second")).otherwise(F.col("__first"))
    res = F.when(_blank(v), _result(F.lit("MISSING"), F.lit(0.0))).otherwise(_result(F.when(score >= threshold, "GROUNDED").otherwise("UNVERIFIED"), F.round(score, 6)))
    return d.withColumn(out, res).drop("__first", "__second")


def verify_number(value: Column, evidence: Column, source: Column, tolerance: float = 0.01) -> Column:
    """The first number of the evidence, then of the source, that is within the tolerance; the score is 1 less the relative difference."""
    x = first_number(value)
    told = F.concat(F.coalesce(all_numbers(evidence), F.array().cast("array<double>")), F.coalesce(all_numbers(source), F.array().cast("array<double>")))
    off = F.filter(F.transform(F.filter(told, lambda n: n != 0), lambda n: F.abs(x - n) / F.abs(n)), lambda r: r <= tolerance)
    hit = F.get(off, F.lit(0))
    return F.when(x.isNull(), _result(F.lit("MISSING"), F.lit(0.0))).when(hit.isNotNull(), _result(F.lit("GROUNDED"), F.round(1 - hit, 9))).otherwise(_result(F.lit("UNVERIFIED"), F.lit(0.0)))


def verify_date(value: Column, evidence: Column, source: Column) -> Column:
    """A date of the evidence, else of the source, at most a day off; a value without a date is MISSING."""
    d = first_date(value)
    score = F.coalesce(date_score(d, evidence), date_score(d, source))
    return F.when(d.isNull(), _result(F.lit("MISSING"), F.lit(0.0))).when(score.isNotNull(), _result(F.lit("GROUNDED"), score)).otherwise(_result(F.lit("UNVERIFIED"), F.lit(0.0)))


def verify_url(value: Column, source: Column) -> Column:
    """The cleaned address in the source scores 1, without its scheme 0.95."""
    u, s = F.lower(sanitize_url(value)), F.lower(source)
    bare = F.regexp_replace(u, "https?://", "")
    inside = lambda x: F.coalesce(F.contains(s, x), F.lit(False))
    return F.when(_blank(value), _result(F.lit("MISSING"), F.lit(0.0))).when(inside(u), _result(F.lit("GROUNDED"), F.lit(1.0))).when(inside(bare), _result(F.lit("GROUNDED"), F.lit(0.95))).otherwise(_result(F.lit("UNVERIFIED"), F.lit(0.0)))


def verify_fields(d: DataFrame) -> DataFrame:
    """``d`` (field_name, value, evidence, source) plus status and score, each field verified by the class of its name."""
    kind = classify_field(F.col("field_name"))
    text = d.where(kind == "text")
    out = verify_texts(text, out="r")
    for name, res in (("numeric", verify_number(F.col("value"), F.col("evidence"), F.col("source"))), ("date", verify_date(F.col("value"), F.col("evidence"), F.col("source"))), ("url", verify_url(F.col("value"), F.col("source")))):
        out = out.unionByName(d.where(kind == name).withColumn("r", res))
    return out.withColumn("status", F.col("r.status")).withColumn("score", F.col("r.score")).drop("r")


def record_verdict(fields: DataFrame, key: str = "record_id") -> DataFrame:
    """``key, fields, ratio, verdict``: rejected if any field is CONFLICTING; grounded if all are, partial from half of them, else unverified."""
    ratio = F.count_if(F.col("status") == "GROUNDED") / F.count(F.lit(1))
    verdict = F.when(F.bool_or(F.col("status") == "CONFLICTING"), "rejected").when(ratio >= 1, "grounded").when(ratio >= 0.5, "partial").otherwise("unverified")
    return fields.groupBy(key).agg(F.count(F.lit(1)).alias("fields"), F.round(ratio, 6).alias("ratio"), verdict.alias("verdict"))
