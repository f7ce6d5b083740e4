"""From model answers and page metadata to long fields: schema rules, evidenced values, relationships, merging, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prices for 1000 tokens in and out.
PRICES = {"gemini": (0.000075, 0.0003), "groq": (0.00059, 0.00079), "deepseek": (0.00014, 0.00028)}
META_TITLE = ["citation_title", "og:title", "twitter:title", "dc.title"]
META_DESCRIPTION = ["og:description", "twitter:description", "description"]
META_DATE = ["citation_date", "citation_publication_date", "article:published_time", "date"]
META_AUTHOR = ["citation_author", "author", "article:author"]


def schema_errors(rules: list[tuple[str, str, object]]) -> Column:
    """Array of failed rules. A rule: (column, kind, argument); kinds: required, const, numeric, range (low, high), pattern, one_of."""
    checks = []
    for name, kind, arg in rules:
        c = F.col(name).cast("string")
        blank = F.coalesce(F.trim(c), F.lit("")) == ""
        if kind == "required":
            bad = blank
        elif kind == "const":
            bad = ~blank & (c != F.lit(arg))
        elif kind == "numeric":
            bad = ~blank & c.try_cast("double").isNull()
        elif kind == "range":
            bad = ~blank & ~F.coalesce(c.try_cast("double").between(arg[0], arg[1]), F.lit(False))
        elif kind == "pattern":
            bad = ~blank & ~c.rlike(arg)
        elif kind == "one_of":
            bad = ~blank & ~c.isin(*arg)
        else:
            raise ValueError(f"unknown rule {kind}")
        checks.append(F.when(bad, F.lit(f"{name}:{kind}")))
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def evidenced_fields(df: DataFrame, key: str, answer: str) -> DataFrame:
    """``key, field_name, idx, value, evidence, confidence``: any key of a model's JSON object in long form.

    An object with a value is an evidenced field; a list gives one row an item; a scalar is wrapped with confidence 0.
    ``relationships`` is left out. Text that is no JSON object gives no row. Dynamic keys stay in the JVM as VARIANT.
    """
    d = df.select(F.col(f"`{key}`").alias("k"), F.try_parse_json(F.col(f"`{answer}`")).alias("v")).where("v IS NOT NULL AND schema_of_variant(v) LIKE 'OBJECT<%'")
    d = d.lateralJoin(d.sparkSession.tvf.variant_explode(F.col("v").outer()).select(F.col("key").alias("field_name"), F.col("value").alias("fv"))).where("field_name <> 'relationships'")
    kind = F.expr("schema_of_variant(fv)")
    items = d.withColumn("xs", F.when(kind.startswith("ARRAY"), F.expr("try_cast(fv AS array<variant>)")).otherwise(F.array("fv"))).withColumn("list", kind.startswith("ARRAY"))
    x = items.select("k", "field_name", "list", F.posexplode("xs").alias("p", "x"))
    obj = F.expr("schema_of_variant(x) LIKE 'OBJECT<%'")
    at = lambda p, t: F.expr(f"try_variant_get(x, '$.{p}', '{t}')")
    return x.select(
        F.col("k").alias(key), "field_name", F.when(F.col("list"), F.col("p")).alias("idx"), F.when(obj, at("value", "string")).otherwise(F.expr("try_variant_get(x, '$', 'string')")).alias("value"),
        F.when(obj, at("evidence", "string")).alias("evidence"), F.when(obj, F.coalesce(at("confidence", "double"), F.lit(0.0))).otherwise(0.0).alias("confidence"),
    )


def relationships(df: DataFrame, key: str, answer: str) -> DataFrame:
    """``key, source, target, type, evidence, confidence`` of the answers' relationships that name all three."""
    s = "relationships array<struct<source:string,target:string,type:string,evidence:string,confidence:double>>"
    d = df.select(F.col(f"`{key}`").alias(key), F.explode(F.from_json(F.col(f"`{answer}`"), s)["relationships"]).alias("r")).select(key, "r.*").where("source IS NOT NULL AND target IS NOT NULL AND type IS NOT NULL")
    return d.withColumn("evidence", F.substring(F.coalesce("evidence", F.lit("")), 1, 1000)).withColumn("confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("confidence", F.lit(0.0)))))


def meta_value(metas: Column, names: list[str]) -> Column:
    """The first non-blank content of the given names, in their order of precedence; ``metas``: array<struct<name, content>>."""

    def first(name: str) -> Column:
        named = F.filter(metas, lambda m: (m["name"] == name) & (F.trim(m["content"]) != ""))
        return F.get(F.transform(named, lambda m: m["content"]), F.lit(0))

    return F.coalesce(*[first(n) for n in names])


def page_metadata(parts: DataFrame, key: str, url: str | None = None) -> DataFrame:
    """Rule-based fields of a page (title, description, author, date) by precedence; the date else from /20yy/mm/dd/ in its URL."""
    m = F.col("metas")
    date = meta_value(m, META_DATE)
    if url:
        found = F.regexp_extract(url, r"/(20\d{2}/\d{1,2}/\d{1,2})/", 1)
        date = F.coalesce(date, F.when(found != "", F.regexp_replace(found, "/", "-")))
    return parts.select(key, F.coalesce(meta_value(m, META_TITLE), F.when(F.col("title") != "", F.col("title"))).alias("title"), F.substring(meta_value(m, META_DESCRIPTION), 1, 500).alias("description"), meta_value(m, META_AUTHOR).alias("author"), date.alias("date"))


def _evidenced(name: str, value: Column, confidence: float, evidence: Column | None = None) -> Column:
    given = F.when(F.coalesce(F.trim(value), F.lit("")) != "", value)
    return F.when(given.isNotNull(), F.struct(F.lit(name).alias("field_name"), F.lit(None).cast("int").alias("idx"), given.alias("value"), F.coalesce(given if evidence is None else evidence, given).alias("evidence"), F.lit(confidence).alias("confidence")))


def _listed(name: str, value: Column, separator: str, confidence: float) -> Column:
    items = F.filter(F.transform(F.split(value, separator), lambda x: F.trim(x)), lambda x: x != "")
    return F.transform(items, lambda x, i: F.struct(F.lit(name).alias("field_name"), i.alias("idx"), x.alias("value"), x.alias("evidence"), F.lit(confidence).alias("confidence")))


_FIELDS = "array<struct<field_name:string,idx:int,value:string,evidence:string,confidence:double>>"


def _long(parts: DataFrame, key: str, single: list[Column], lists: list[Column]) -> DataFrame:
    both = F.concat(F.filter(F.array(*single), lambda x: x.isNotNull()).cast(_FIELDS), *[F.coalesce(x.cast(_FIELDS), F.array().cast(_FIELDS)) for x in lists])
    return parts.select(key, F.explode(both).alias("f")).select(key, "f.*")


def paper_metadata(parts: DataFrame, key: str, url: str, confidence: float = 0.85) -> DataFrame:
    """``key, field_name, idx, value, evidence, confidence``: a paper page's fields from its meta tags, evidenced, with no model.

    ``parts``: metas, title, and the page's address in ``url``. Authors and categories give one row each.
    """
    m = F.col("metas")
    number = F.regexp_extract(url, r"arxiv\.org/abs/([0-9]+\.[0-9]+)", 1)
    single = [
        _evidenced("title", F.coalesce(meta_value(m, ["citation_title", "og:title", "title"]), F.col("title")), confidence),
        _evidenced("abstract", F.substring(meta_value(m, ["description", "og:description"]), 1, 500), confidence),
        _evidenced("publishedDate", meta_value(m, ["citation_date", "citation_publication_date"]), confidence),
        _evidenced("arxivId", number, confidence, F.concat(F.lit("ArXiv ID from URL: arxiv.org/abs/"), number)),
        _evidenced("website", F.col(url), confidence),
    ]
    return _long(parts, key, single, [_listed("authors", meta_value(m, ["citation_author", "author"]), "[,;]", confidence), _listed("categories", meta_value(m, ["citation_keywords"]), ",", confidence)])


def page_fields(parts: DataFrame, key: str, url: str, confidence: float = 0.70) -> DataFrame:
    """The fields of :func:`page_metadata` in the same long form, for pages that no model has read."""
    d = page_metadata(parts, key, url).join(parts.select(key, F.col(url).alias("__url")), key)
    return _long(d, key, [_evidenced(n, F.col(c), confidence) for n, c in (("title", "title"), ("description", "description"), ("author", "author"), ("publishedDate", "date"), ("website", "__url"))], [])


def read_answer(c: Column) -> Column:
    """A model's answer as VARIANT: a code fence is stripped; an object is itself, a list becomes ``{"items": list}``; else the
    widest braces, else the widest brackets; else an empty object."""
    x = F.trim(F.regexp_replace(F.regexp_replace(F.trim(c), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))
    wrap = lambda t: F.concat(F.lit('{"items":'), t, F.lit("}"))
    obj = lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v)
    arr = lambda t: F.when(F.schema_of_variant(F.try_parse_json(t)).startswith("ARRAY"), F.try_parse_json(wrap(t)))
    return F.coalesce(obj(F.try_parse_json(x)), arr(x), obj(F.try_parse_json(F.regexp_extract(x, r"(?s)(\{.*\})", 1))), arr(F.regexp_extract(x, r"(?s)(\[.*\])", 1)), F.try_parse_json(F.lit("{}")))


def merge_chunks(fields: DataFrame) -> DataFrame:
    """One row per record and field: the first chunk that has it wins (record_id, field_name, chunk_index, value)."""
    return fields.where("value IS NOT NULL").groupBy("record_id", "field_name").agg(F.min_by("value", "chunk_index").alias("value"), F.min("chunk_index").alias("chunk_index"))


def cost(provider: Column, tokens_in: Column, tokens_out: Column) -> Column:
    pin = F.create_map(*[F.lit(x) for k, v in PRICES.items() for x in (k, v[0])])[provider]
    pout = F.create_map(*[F.lit(x) for k, v in PRICES.items() for x in (k, v[1])])[provider]
    return tokens_in / 1000 * F.coalesce(pin, F.lit(0.0)) + tokens_out / 1000 * F.coalesce(pout, F.lit(0.0))


def error_class(message: Column) -> Column:
    """rate_limit, context_length or generic, by the error's text."""
    m = F.lower(message)
    return F.when(m.rlike("429|rate.?limit|quota|too many requests|resource.?exhausted"), "rate_limit").when(m.rlike("context.?length|too long|maximum context|token limit"), "context_length").otherwise("generic")


def prompt(template: Column, content: Column) -> Column:
    return F.replace(template, F.lit("{content}"), content)


#: What a model is asked for, by record type; ``{content}`` is the page's text.
PROMPTS = {
    kind: f"Read the page below and answer with one JSON object about the {what} it describes. For each of {fields}: an object with value, evidence (a sentence of the page, word for word) and confidence (0 to 1); lists as lists of such "
    "objects. Leave out what the page does not say. Put relations into relationships (source, target, type, evidence, confidence).\n\n{content}"
    for kind, what, fields in (
        ("STARTUP", "company", "description, foundedDate, founders, headquarters, industry, fundingTotal, employeeCount, website, investors, products"), ("PRODUCT", "product", "description, company, category, launchDate, pricing, features, platforms, website"),
        ("PAPER", "paper", "title, abstract, authors, publishedDate, categories, citations"), ("JOB", "open position", "title, company, location, remotePolicy, employmentType, salaryMin, salaryMax, skills, postedDate"),
        ("NEWS_SIGNAL", "news item", "title, summary, publishedDate, author, publisher, mentionedEntities, keyTopics"),
    )
}


def prompts(record_type: Column, content: Column, templates: dict[str, str] | None = None) -> Column:
    """The prompt of each record; a type without a template gets the one of companies."""
    t = templates or PROMPTS
    table = F.create_map(*[F.lit(x) for kv in t.items() for x in kv])
    return prompt(F.coalesce(table[record_type], F.lit(t["STARTUP"])), F.coalesce(content, F.lit("")))
