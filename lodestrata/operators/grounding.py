"""Grounding of extracted fields in their source text, fabrication checks and trust, on the long field table.

Columns expected: record_id, record_type, field_name, value, evidence, confidence and source (the text it was taken from).
Native expressions but for evidence that the source does not have literally, whose ratio is computed in Arrow batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import partial_ratio_udf
from .voting import TIES, normalized_value

# Generic openers, commonly assumed values, outlier bounds, required and classified fields.
GENERIC = r"(?i)^(the company (is|was) founded|according to (the|their) website|based on (available|public) (data|information)|it is (known|reported|stated) that|(the |this )?(source|article|page) (states|mentions|says))"
ASSUMED = ["2023", "2022", "2021", "San Francisco", "Silicon Valley", "Series A", "Series B", "AI-powered", "cutting-edge"]
BOUNDS = {"fundingTotal": (1e3, 5e11), "employeeCount": (1.0, 5e6), "salary": (1e4, 1e7), "citations": (0.0, 1e6)}
NUMERIC_FIELDS = "fundingTotal lastFundingRound employeeCount salaryMin salaryMax githubStars citations valuation revenue price pricing".split()
DATE_FIELDS = "foundedDate launchDate publishedDate postedDate closingDate lastUpdated publishedAt".split()
URL_FIELDS = "website githubUrl linkedinUrl twitterUrl crunchbaseUrl productHuntUrl arxivUrl".split()
URL_CHECKED = ["website", "url", "sourceUrl", "githubUrl"]
URL_SHAPE = r"^https?://[a-zA-Z0-9]([a-zA-Z0-9-]*[a-zA-Z0-9])?(\.[a-zA-Z0-9]([a-zA-Z0-9-]*[a-zA-Z0-9])?)*(/\S*)?$"
#: Least ratio of evidence and source that grounds a text, and that a number needs besides being in the source.
TEXT_RATIO, NUMBER_RATIO = 90.0, 70.0
MULTIPLES = {"k": 1e3, "thousand": 1e3, "m": 1e6, "mm": 1e6, "million": 1e6, "b": 1e9, "bn": 1e9, "billion": 1e9, "t": 1e12, "trillion": 1e12}
NUMBER = r"(\d[\d,]*\.?\d*)(?:\s*(?i:(thousand|million|billion|trillion|mm|bn|k|m|b|t))(?:[^\p{L}\p{N}_]|$))?"


def flat(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def classify_field(name: Column) -> Column:
    return F.when(name.isin(NUMERIC_FIELDS), "numeric").when(name.isin(DATE_FIELDS), "date").when(name.isin(URL_FIELDS), "url").otherwise("text")


def number_of(digits: Column, suffix: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in MULTIPLES.items() for x in kv])
    return F.regexp_replace(digits, ",", "").try_cast("double") * F.coalesce(table[F.lower(suffix)], F.lit(1.0))


def first_number(c: Column) -> Column:
    """The first number of a text with its suffix (k, million, bn, ...), which must be a word of its own."""
    return number_of(F.regexp_extract(c, NUMBER, 1), F.regexp_extract(c, NUMBER, 2))


def all_numbers(c: Column) -> Column:
    d, s = F.regexp_extract_all(c, F.lit(NUMBER), F.lit(1)), F.regexp_extract_all(c, F.lit(NUMBER), F.lit(2))
    return F.filter(F.zip_with(d, s, number_of), lambda x: x.isNotNull())


def near_number(x: Column, numbers: Column, tolerance: float = 0.01) -> Column:
    """Whether some number of the array is nonzero and within the tolerance of ``x``."""
    return F.exists(numbers, lambda n: (n != 0) & (F.abs(x - n) <= F.abs(n) * tolerance))


def word_overlap(words: Column, source: Column) -> Column:
    """Share of the words (with repeats) that the source also has."""
    both = F.struct(F.split(flat(words), " ").alias("w"), F.array_distinct(F.split(flat(source), " ")).alias("s"))
    # both word lists are bound once, not once a word
    share = lambda t: F.size(F.filter(t["w"], lambda x: F.array_contains(t["s"], x))) / F.size(t["w"])
    return F.get(F.transform(F.array(both), share), F.lit(0))


def verify_field(d: DataFrame) -> DataFrame:
    """``d`` plus status (GROUNDED, UNVERIFIED, MISSING) and grounding 0..100.

    A text is grounded where its evidence is at least ``TEXT_RATIO`` like some part of the source, a number where the source
    has it and the evidence is at least ``NUMBER_RATIO`` like, an address where the source contains it. Evidence that the
    source contains (blanks do not count) is 100 like; only for the rest is the partial ratio computed.
    """
    value, ev, src = F.trim("value"), F.trim("evidence"), F.col("source")
    is_num = F.regexp_replace(value, r"[$€£¥,\s]", "").rlike(r"^\d+\.?\d*[BMKbmk]?$")
    is_url = ~is_num & F.lower(value).rlike(r"^(https?://|www\.)")
    x = first_number(value)
    num_ok = F.coalesce(near_number(x, all_numbers(src)) & (x != 0), F.lit(False))
    bare = F.regexp_replace(F.regexp_replace(F.lower(value), r"/+$", ""), r"^https?://", "")
    blank = F.coalesce(value, F.lit("")) == ""
    unproved = F.coalesce(ev, F.lit("")) == ""
    inside = F.coalesce(F.contains(flat(src), flat(ev)), F.lit(False))
    d = d.withColumn("_open", ~blank & ~unproved & ~is_url & ~inside)
    d = d.withColumn("_like", F.coalesce(partial_ratio_udf(F.when(F.col("_open"), F.lower(ev)), F.when(F.col("_open"), F.lower(src))), F.lit(0.0)))
    like = F.when(F.col("_open"), F.col("_like")).otherwise(100.0)
    url_ok = F.coalesce(F.contains(F.lower(src), bare), F.lit(False))
    ok = F.when(is_num, num_ok & (like >= NUMBER_RATIO)).when(is_url, url_ok).otherwise(like >= TEXT_RATIO)
    status = F.when(blank, "MISSING").when(unproved, "UNVERIFIED").when(ok, "GROUNDED").otherwise("UNVERIFIED")
    score = F.when(blank | unproved, 0.0).when(is_num & ok, 100.0).when(is_url, F.when(url_ok, 100.0).otherwise(0.0)).otherwise(like)
    return d.withColumn("status", status).withColumn("grounding", F.round(score, 6)).drop("_open", "_like")


def _flag(kind: str, severity: str, when: Column) -> Column:
    return F.when(when, F.struct(F.lit(kind).alias("check_type"), F.lit(severity).alias("severity")))


def field_checks(d: DataFrame, now_year: int, min_evidence: int = 10, inflation: float = 0.35) -> DataFrame:
    """``d`` plus ``flags``, an array of (check_type, severity) of the field's failed checks; null for a blank value."""
    v, e, src = F.coalesce(F.col("value"), F.lit("")), F.coalesce(F.col("evidence"), F.lit("")), F.col("source")
    words = F.split(flat(e), " ")
    short = F.length(e) < min_evidence
    inside = F.contains(flat(src), flat(e))
    g = F.when(F.col("grounding") > 1, F.col("grounding") / 100).otherwise(F.col("grounding"))
    year = F.regexp_extract(v, r"(\d{4})", 1).try_cast("int")
    plain = F.regexp_replace(v, r"[$€£¥,\s]", "")
    suffix = F.lower(F.substring(plain, -1, 1))
    mult = F.when(suffix == "t", 1e12).when(suffix == "b", 1e9).when(suffix == "m", 1e6).when(suffix == "k", 1e3)
    amount = F.when(mult.isNotNull(), F.regexp_replace(plain, r".$", "").try_cast("double") * mult).otherwise(plain.try_cast("double"))
    low = F.create_map(*[F.lit(x) for k, b in BOUNDS.items() for x in (k, b[0])])[F.col("field_name")]
    high = F.create_map(*[F.lit(x) for k, b in BOUNDS.items() for x in (k, b[1])])[F.col("field_name")]
    vw = F.split(flat(v), " ")
    whole = F.when(plain.rlike(r"^\d+(\.\d+)?$"), F.contains(src, F.regexp_replace(plain, r"\..*$", ""))).otherwise(False)
    attributed = (F.length(v) < 3) | F.contains(F.lower(src), F.lower(F.trim(v))) | whole | ((F.size(vw) >= 2) & (word_overlap(v, src) >= 0.6))
    assumed = v.isin(ASSUMED) & (F.col("confidence") > 0.9)
    generic = (e != "") & e.rlike(GENERIC)
    checks = F.array(
        _flag("fabrication", "warning", short),
        _flag("fabrication", "critical", ~short & ~inside & (F.size(words) >= 3) & (word_overlap(e, src) < 0.7)),
        _flag("inflation", "warning", (g > 0) & (F.col("confidence") - g > inflation)),
        _flag("suspicious", "warning", generic),
        _flag("suspicious", "info", ~generic & assumed),
        _flag("suspicious", "critical", ~generic & ~assumed & F.col("field_name").isin("foundedDate", "publishedDate", "postedDate") & (year > now_year + 1)),
        _flag("attribution", "warning", ~attributed),
        _flag("url_format", "warning", F.col("field_name").isin(URL_CHECKED) & ~v.rlike(URL_SHAPE)),
        _flag("outlier", "critical", (amount < low) | (amount > high)),
    )
    return d.withColumn("flags", F.filter(F.when(F.trim(v) != "", checks), lambda x: x.isNotNull()))


def flag_rows(checked: DataFrame) -> DataFrame:
    """``record_id, field_name, check_type, severity``: one row per flag of :func:`field_checks`."""
    return checked.select("record_id", "field_name", F.explode("flags").alias("f")).select("record_id", "field_name", "f.*")


def field_flags(d: DataFrame, now_year: int, min_evidence: int = 10, inflation: float = 0.35) -> DataFrame:
    """``record_id, field_name, check_type, severity``: one row per failed check of a field."""
    return flag_rows(field_checks(d.where(F.trim("value") != ""), now_year, min_evidence, inflation))


def duplicate_evidence(d: DataFrame, least: int = 3) -> DataFrame:
    """``record_id, evidence_key, fields``: evidence of at least ten characters that several fields of a record share."""
    k = F.lower(F.trim("evidence"))
    return d.where(F.length(k) >= 10).groupBy("record_id", k.alias("evidence_key")).agg(F.count(F.lit(1)).alias("fields")).where(F.col("fields") >= least)


def uniform_confidence(d: DataFrame, least: int = 4) -> DataFrame:
    """``record_id, fields``: records whose confidences are suspiciously all the same."""
    return d.where("confidence IS NOT NULL").groupBy("record_id").agg(F.count(F.lit(1)).alias("fields"), F.count_distinct(F.round("confidence", 3)).alias("n")).where((F.col("fields") >= least) & (F.col("n") == 1)).drop("n")


def missing_required(d: DataFrame, required: list[str]) -> DataFrame:
    """``record_id, missing, severity``: one missing field is a warning, more are critical."""
    have = d.where(F.trim("value") != "").groupBy("record_id").agg(F.collect_set(F.when(F.col("field_name").isin(required), F.col("field_name"))).alias("have"))
    all_ = d.select("record_id").distinct().join(have, "record_id", "left")
    m = F.size(F.array_except(F.array(*map(F.lit, required)), F.coalesce("have", F.array().cast("array<string>"))))
    return all_.select("record_id", m.alias("missing")).where("missing > 0").withColumn("severity", F.when(F.col("missing") > 1, "critical").otherwise("warning"))


def cross_field(d: DataFrame) -> DataFrame:
    """``record_id, field_name, check_type, severity``: contradictions between a record's description and its other fields.

    Every "founded (in) YYYY" of the description that is not the founded year is critical; a first amount that is not the
    funding's first amount is a warning. A record with several rows of a field is held against the last by ``value``.
    """
    of = lambda n: F.max(F.when(F.col("field_name") == n, F.col("value"))).alias(n)
    x = d.where(F.col("field_name").isin("foundedDate", "fundingTotal", "description")).groupBy("record_id").agg(of("foundedDate"), of("fundingTotal"), of("description"))
    year = F.regexp_extract("foundedDate", r"\d{4}", 0)
    told = F.regexp_extract_all("description", F.lit(r"(?i)founded\s+(?:in\s+)?(\d{4})"), F.lit(1))
    amount = lambda c: F.lower(F.regexp_extract(c, r"(?i)\$[\d.]+\s*[BMK]", 0))
    years = F.transform(F.filter(told, lambda y: (year != "") & (y != year)), lambda y: F.struct(F.lit("foundedDate↔description").alias("field_name"), F.lit("contradiction").alias("check_type"), F.lit("critical").alias("severity")))
    a, b = amount("fundingTotal"), amount("description")
    funding = F.when((a != "") & (b != "") & (a != b), F.array(F.struct(F.lit("fundingTotal↔description").alias("field_name"), F.lit("contradiction").alias("check_type"), F.lit("warning").alias("severity"))))
    none = F.array().cast("array<struct<field_name:string,check_type:string,severity:string>>")
    return x.select("record_id", F.explode(F.concat(F.coalesce(years, none), F.coalesce(funding, none))).alias("f")).select("record_id", "f.*")


def record_flags(d: DataFrame, required: list[str]) -> DataFrame:
    """``record_id, field_name, check_type, severity``: one row per failed check of a whole record; together with
    :func:`field_flags` these are the flags that trust and record status read."""
    flag = lambda x, name, kind, severity: x.select("record_id", name.alias("field_name"), F.lit(kind).alias("check_type"), severity.alias("severity"))
    warning = F.lit("warning")
    out = cross_field(d).unionByName(flag(duplicate_evidence(d), F.lit("*"), "duplicate_evidence", warning))
    out = out.unionByName(flag(uniform_confidence(d), F.lit("*"), "uniformity", warning))
    return out.unionByName(flag(missing_required(d, required), F.lit("*"), "completeness", F.col("severity")))


def trust(d: DataFrame, flags: DataFrame) -> DataFrame:
    """``record_id, fields_checked, critical, warnings, infos, trust_score, recommendation, trustworthy``."""
    checked = d.where(F.trim("value") != "").groupBy("record_id").agg(F.count(F.lit(1)).alias("fields_checked"))
    f = flags.groupBy("record_id").agg(*[F.count_if(F.col("severity") == s).alias(n) for s, n in (("critical", "critical"), ("warning", "warnings"), ("info", "infos"))])
    x = checked.join(f, "record_id", "left").fillna(0, ["critical", "warnings", "infos"])
    x = x.withColumn("trust_score", F.round(F.greatest(F.lit(0.0), 1 - 0.25 * F.col("critical") - 0.10 * F.col("warnings") - 0.03 * F.col("infos")), 4))
    x = x.withColumn("recommendation", F.when((F.col("critical") > 0) | (F.col("trust_score") < 0.4), "reject").when((F.col("warnings") > 0) | (F.col("trust_score") < 0.7), "review").otherwise("accept"))
    return x.withColumn("trustworthy", (F.col("critical") == 0) & (F.col("trust_score") >= 0.6))


def record_status(verified: DataFrame, flags: DataFrame | None = None) -> DataFrame:
    """``record_id, total, grounded, ratio, record_status``; missing fields count, and a critical flag makes a record unverified."""
    r = verified.groupBy("record_id").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "GROUNDED").alias("grounded"))
    r = r.withColumn("ratio", F.round(F.col("grounded") / F.col("total"), 6))
    s = F.when(F.col("grounded") == F.col("total"), "grounded").when(F.col("ratio") >= 0.5, "partial").otherwise("unverified")
    if flags is None:
        return r.withColumn("record_status", s)
    bad = flags.where("severity = 'critical'").select("record_id").distinct().withColumn("bad", F.lit(True))
    return r.join(bad, "record_id", "left").withColumn("record_status", F.when(F.col("bad"), "unverified").otherwise(s)).drop("bad")


def list_grounding(verified: DataFrame) -> DataFrame:
    """``record_id, field_name, items, score, grounded``: mean grounding of a list field's items; grounded if at least half are."""
    x = verified.groupBy("record_id", "field_name").agg(F.count(F.lit(1)).alias("items"), F.round(F.avg("grounding") + TIES, 4).alias("score"), F.avg((F.col("status") == "GROUNDED").cast("double")).alias("part"))
    return x.withColumn("grounded", F.col("part") >= 0.5).drop("part")


def lineage(votes: DataFrame, scored: DataFrame) -> DataFrame:
    """``entity_id, sources, fields, contested_fields, mean_confidence``: distinct sources, contested fields and mean confidence of an entity."""
    src = scored.groupBy("entity_id").agg(F.count_distinct("source_url").alias("sources"))
    v = votes.groupBy("entity_id").agg(F.count(F.lit(1)).alias("fields"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("contested"), F.col("field_name")))), ",").alias("contested_fields"), F.round(F.avg("confidence") + TIES, 4).alias("mean_confidence"))
    return v.join(src, "entity_id")


def lineage_traces(votes: DataFrame, scored: DataFrame) -> DataFrame:
    """Each assertion's part in its field: winner, dissenter or single_source, its quality and whether it passed."""
    d = scored.where("value IS NOT NULL").join(votes.select("entity_id", "field_name", "winner", "n"), ["entity_id", "field_name"])
    role = F.when(F.col("n") == 1, "single_source").when(normalized_value(F.col("value")) == normalized_value(F.col("winner")), "winner").otherwise("dissenter")
    return d.select("assertion_id", "entity_id", "field_name", role.alias("role"), F.round(F.col("g") * F.col("t") + TIES, 4).alias("quality"), (F.col("g") >= 0.6).alias("passed"))


def contained(d: DataFrame) -> DataFrame:
    """``d`` plus evidence_in_source and value_in_evidence: whether one text holds the other, blanks and case apart."""
    return d.withColumn("evidence_in_source", F.contains(flat(F.col("source")), flat(F.col("evidence")))).withColumn("value_in_evidence", F.contains(F.lower("evidence"), F.lower("value")))


def evidence_chain(d: DataFrame, keys: list[str], value: str = "value", evidence: str = "evidence_text", at: str = "fetched_at") -> DataFrame:
    """``keys``, extracted_value and evidence_text, cut for the record, and verified_us: when it was read, if the evidence holds the value."""
    ok = F.contains(F.lower(evidence), F.lower(value))
    return d.select(*keys, F.substring(value, 1, 500).alias("extracted_value"), F.substring(evidence, 1, 1000).alias("evidence_text"), F.when(ok, F.unix_micros(F.col(at).cast("timestamp"))).alias("verified_us"))
