"""Listings as rows: feeds by XPath, JSON APIs, links of pages, and paged APIs as a Python data source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words that make a feed entry worth following.
STARTUP_WORDS = r"startup|ai |raises|funding|launch"


def feed_links(feeds: DataFrame, key: str, xml: str, cap: int | None = 300) -> DataFrame:
    """``key, pos, url``: links of RSS items (else http guids) and Atom entries, each URL once per feed, in order.

    ``cap`` is the feed's documented maximum of entries; None keeps all. Text that is no XML gives no row.
    """
    x = F.regexp_replace(F.col(f"`{xml}`"), r'xmlns(:\w+)?="[^"]*"', "")
    safe = F.when(x.rlike(r"^\s*<(\?xml|rss|feed)"), x).otherwise("<none/>")
    urls = F.concat(
        F.xpath(safe, F.lit("//item/link/text()")), F.xpath(safe, F.lit("//item[not(link)]/guid[starts-with(text(),'http')]/text()")), F.xpath(safe, F.lit("//entry/link[@rel='alternate']/@href")), F.xpath(safe, F.lit("//entry[not(link[@rel='alternate'])]/link[1]/@href"))
    )
    d = feeds.select(F.col(f"`{key}`").alias("k"), F.posexplode(F.array_distinct(F.filter(F.transform(urls, lambda u: F.trim(u)), lambda u: u.rlike("^https?://")))).alias("pos", "url"))
    if cap is not None:
        d = d.where(F.col("pos") < cap)
    return d.select(F.col("k").alias(key), "pos", "url")


def keyword_entries(entries: DataFrame, title: str, summary: str, words: str = STARTUP_WORDS) -> DataFrame:
    return entries.where(F.lower(F.concat_ws(" ", title, summary)).rlike(words))


def json_urls(rows: DataFrame, key: str, payload: str, field: str = "url", items: str = "jobs") -> DataFrame:
    """``key, url`` of the items of JSON listings."""
    d = rows.select(F.col(f"`{key}`").alias("k"), F.explode(F.from_json(F.col(f"`{payload}`"), f"{items} array<struct<{field}:string>>")[items]).alias("x"))
    return d.where(f"x.{field} IS NOT NULL").select(F.col("k").alias(key), F.col(f"x.{field}").alias("url"))


def repository_links(links: Column) -> Column:
    """Links with exactly two slashes, the last part without a dot: repositories on a topic page."""
    return F.array_distinct(F.filter(links, lambda u: u.rlike(r"^/[^/]+/[^/.]+$")))


def discover(urls: DataFrame, seen: DataFrame | None, url: str = "url", source: str = "source_name") -> DataFrame:
    """``urls`` in canonical spelling, without empty ones, once per source, and without what ``seen`` has, with a correlation id."""
    from ..functions.urls import normalize_url

    d = urls.withColumn(url, normalize_url(F.col(url))).where(F.col(url) != "").dropDuplicates([source, url])
    if seen is not None:
        d = d.join(seen.select(source, url).distinct(), [source, url], "left_anti")
    return d.withColumn("correlation_id", F.expr("uuid()"))


def paged_listing(spark: SparkSession, path: str, start: int = 0, ceiling: int = 10_000) -> DataFrame:
    """``offset, pos, item``: the items of saved answers ``page-<offset>.json`` of a paged API, on any file system Spark reads.

    ``ceiling`` is the API's own end of offsets. An answer is one JSON array; one that is none gives no row.
    """
    d = spark.read.option("pathGlobFilter", "page-*.json").text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"page-(\d+)\.json$", 1).cast("int").alias("offset"), "value")
    d = d.where(F.col("offset").between(start, ceiling - 1))
    items = F.expr("try_cast(try_parse_json(value) AS array<variant>)")
    return d.select("offset", F.posexplode(items).alias("pos", "x")).select("offset", "pos", F.to_json("x").alias("item"))


def top_per_page(df: DataFrame, page: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each page, the listing's own limit."""
    return df.withColumn("__r", F.row_number().over(Window.partitionBy(page).orderBy(order))).where(F.col("__r") <= n).drop("__r")
