"""Export: gates, flattened tabs and the mapping log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields required for export, endpoint types of edges.
REQUIRED = {"STARTUP": ["entityName"], "PRODUCT": ["entityName"], "PAPER": ["title"], "JOB": ["title", "company"], "NEWS_SIGNAL": ["title"]}
EDGES = {"FOUNDED_BY": ("STARTUP", ("STARTUP", "PRODUCT")), "BUILDS_PRODUCT": ("STARTUP", ("PRODUCT",)), "PUBLISHED_PAPER": ("STARTUP", ("PAPER",)), "CITES": ("PAPER", ("PAPER",)), "WORKS_AT": ("JOB", ("STARTUP",))}

# Tab of each record type, and its fields with their headers in order of columns, after the common ones.
TABS = {"STARTUP": "Startups", "PRODUCT": "Products", "PAPER": "Papers", "JOB": "Jobs", "NEWS_SIGNAL": "News"}
COMMON = ("Canonical ID", "Entity Name", "Record Type", "Verification Status", "Source URL")
COLUMNS = {
    "STARTUP": {
        "description": "Description", "foundedDate": "Founded Date", "founders": "Founders", "headquarters": "Headquarters", "industry": "Industry", "fundingTotal": "Total Funding",
        "lastFundingRound": "Last Funding Round", "employeeCount": "Employee Count", "website": "Website", "investors": "Investors", "products": "Products", "techStack": "Tech Stack",
    },
    "PRODUCT": {
        "description": "Description", "company": "Company", "category": "Category", "launchDate": "Launch Date", "pricing": "Pricing", "pricingModel": "Pricing Model", "features": "Features",
        "platforms": "Platforms", "website": "Website", "githubUrl": "GitHub URL",
    },
    "PAPER": {
        "title": "Title", "abstract": "Abstract", "authors": "Authors", "publishedDate": "Published Date", "arxivId": "ArXiv ID", "categories": "Categories", "githubUrl": "GitHub URL",
        "githubStars": "GitHub Stars", "citations": "Citations", "affiliations": "Affiliations",
    },
    "JOB": {
        "title": "Title", "company": "Company", "location": "Location", "remotePolicy": "Remote Policy", "employmentType": "Employment Type", "salaryMin": "Salary Min", "salaryMax": "Salary Max",
        "skills": "Skills", "postedDate": "Posted Date",
    },
    "NEWS_SIGNAL": {
        "title": "Title", "summary": "Summary", "publishedDate": "Published Date", "author": "Author", "publisher": "Publisher", "mentionedEntities": "Mentioned Entities", "keyTopics": "Key Topics",
    },
}


def tab_rows(df: DataFrame, record_type: str, content: dict[str, Column], keys: tuple[str, ...] = ("canonical_id", "entity_name", "verification_status", "source_url")) -> DataFrame:
    """One row a record with the headers of its tab: the common columns, then every field, empty where ``content`` has none.

    A field is a scalar or an array column; arrays become their non-blank values joined by "; ".
    """
    cid, name, status, url = (cell(F.col(k)) for k in keys)
    common = [c.alias(h) for c, h in zip((cid, name, F.lit(record_type), status, url), COMMON, strict=True)]
    typed = df.select(*content.values())
    lists = {k for k, f in zip(content, typed.schema.fields, strict=True) if f.dataType.typeName() == "array"}
    one = lambda k: list_cell(content[k]) if k in lists else cell(content[k]) if k in content else F.lit("")
    return df.select(*common, *[one(k).alias(h) for k, h in COLUMNS[record_type].items()])


def mark_batches(entities: DataFrame, key: str, run_at: str, size: int = 500) -> DataFrame:
    """``entities`` plus batch and exported_at: what is not exported yet, flushed in batches of ``size``."""
    from .messages import batches

    d = batches(entities.where("exported_at IS NULL").drop("exported_at").withColumn("__all", F.lit(0)), "__all", [key], size).drop("__all")
    return d.withColumn("exported_at", F.lit(run_at).cast("timestamp"))


def export_errors(schema_valid: Column, status: Column, required: list[Column], method: Column) -> Column:
    """Array of failed gates: schema, status, required, resolution."""
    blank = F.lit(False)
    for c in required:
        blank = blank | (F.coalesce(F.trim(c), F.lit("")) == "")
    checks = F.array(F.when(~schema_valid, "schema"), F.when(status.isin("unverified", "rejected"), "status"), F.when(blank, "required"), F.when(method == "unresolved", "resolution"))
    return F.filter(checks, lambda x: x.isNotNull())


def exportable(record_type: Column, status: Column, schema_valid: Column, name: Column) -> Column:
    ok = status.isin("grounded", "partial")
    return F.when(record_type == "PAPER", ok | (schema_valid & ~F.coalesce(name, F.lit("")).isin("None", ""))).otherwise(ok & schema_valid)


def cell(c: Column, python_none: bool = False) -> Column:
    """A scalar as a cell: null is empty (or "None", as an option)."""
    return F.coalesce(c.cast("string"), F.lit("None" if python_none else ""))


def list_cell(c: Column) -> Column:
    return F.array_join(F.filter(c, lambda x: F.coalesce(F.trim(x), F.lit("")) != ""), "; ")


def valid_edge(kind: Column, source_type: Column, target_type: Column, strict: bool = False) -> Column:
    """Known relation with a fitting source or target (both, if strict)."""
    out = F.lit(False)
    for k, (s, t) in EDGES.items():
        a, b = source_type == s, target_type.isin(*t)
        out = F.when(kind == k, (a & b) if strict else (a | b)).otherwise(out)
    return out


def mapping_log(df: DataFrame) -> DataFrame:
    """Log rows as strings; columns canonical_id, entity_name, record_type, method, confidence, sources, is_seed, status, ratio, url."""
    return df.where("method <> 'unresolved'").select(
        "canonical_id", "entity_name", "record_type", "method", F.format_string("%.3f", "confidence").alias("confidence"), F.col("sources").cast("string").alias("sources"),
        F.when(F.col("is_seed"), "Yes").otherwise("No").alias("is_seed"), "status", F.format_string("%.2f", "ratio").alias("ratio"), cell(F.col("url")).alias("url"),
    )


def implicit_edges(jobs: DataFrame, startups: DataFrame | None = None) -> DataFrame:
    """Edges that records imply: a job works at its company (0.95); a startup builds its listed products (0.8)."""
    e = jobs.where(F.trim("company") != "").select(F.col("canonical_id").alias("source"), F.col("company").alias("target"), F.lit("WORKS_AT").alias("relation_type"), F.lit(0.95).alias("confidence"), "source_url")
    if startups is not None:
        e = e.unionByName(startups.select(F.col("canonical_id").alias("source"), F.explode("products").alias("target"), F.lit("BUILDS_PRODUCT").alias("relation_type"), F.lit(0.8).alias("confidence"), "source_url"))
    return e
