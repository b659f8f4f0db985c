"""Scans: feeds, release lists, pages, configuration and landed results, each to a declared schema."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import texts, times

ARTICLE = "url string, title string, summary string, published string, author string, source_id string, source_name string, source_type string, default_category string, content_preview string, raw_extra string"


def rss(spark: SparkSession, path: str, as_of: Column, max_days: int = 7, tag: str = "item") -> DataFrame:
    """Items of landed RSS files not older than max_days; undated items stay."""
    raw = spark.read.format("xml").option("rowTag", tag).schema("title string, link string, description string, pubDate string, author string").load(path)
    dated = raw.withColumn("published_at", times.parse_feed(F.col("pubDate")))
    return dated.where(F.col("published_at").isNull() | (F.col("published_at") >= as_of - F.make_dt_interval(F.lit(max_days)))).select(
        F.col("link").alias("url"), texts.sanitize(F.col("title")).alias("title"), texts.strip_html(F.col("description"), 2000).alias("summary"), "published_at", "author"
    )


def atom(spark: SparkSession, path: str, as_of: Column, max_days: int = 7) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "entry").schema("title string, id string, link struct<_href string>, summary string, updated string, published string").load(path)
    dated = raw.withColumn("published_at", times.parse_iso(F.coalesce("updated", "published")))
    return dated.where(F.col("published_at").isNull() | (F.col("published_at") >= as_of - F.make_dt_interval(F.lit(max_days)))).select(
        F.coalesce("link._href", "id").alias("url"), texts.sanitize(F.col("title")).alias("title"), texts.strip_html(F.col("summary"), 3000).alias("summary"), "published_at"
    )


def papers(spark: SparkSession, path: str, most: int = 10) -> DataFrame:
    """Landed results of a paper archive, newest first: summary cut, the first five authors named."""
    raw = spark.read.schema("url string, title string, summary string, updated string, published string, authors array<string>, category string").json(path)
    when = F.coalesce("updated", "published")
    return raw.select("url", "title", F.left("summary", F.lit(3000)).alias("summary"), when.alias("published"), F.array_join(F.slice("authors", 1, 5), ", ").alias("author"), F.element_at(F.split("category", "/"), -1).alias("category")).orderBy(F.desc_nulls_last("published"), "url").limit(most)


def releases(spark: SparkSession, path: str, as_of: Column, max_days: int = 7) -> DataFrame:
    raw = spark.read.schema("html_url string, name string, tag_name string, body string, published_at string, assets array<struct<name string, size long>>").json(path)
    published = times.parse_iso(F.col("published_at"))
    return raw.where(published >= as_of - F.make_dt_interval(F.lit(max_days))).select(
        F.col("html_url").alias("url"), F.concat(F.lit("Release: "), F.coalesce(F.nullif("name", F.lit("")), "tag_name")).alias("title"), F.left("body", F.lit(3000)).alias("summary"), published.alias("published"), F.slice("assets", 1, 10).alias("assets")
    )


def trending(pages: DataFrame, html: str = "html", most: int = 10) -> DataFrame:
    """Repositories of landed trending pages (page_id, html): (page_id, ordinal, owner, repo)."""
    rows = F.slice(F.regexp_extract_all(F.col(html), F.lit(r'(?s)<h2[^>]*>\s*<a[^>]*href="/([^"/]+/[^"/]+)"'), F.lit(1)), 1, most)
    found = pages.select("page_id", F.posexplode(rows).alias("ordinal", "name"))
    return found.select("page_id", "ordinal", F.split_part("name", F.lit("/"), F.lit(1)).alias("owner"), F.split_part("name", F.lit("/"), F.lit(2)).alias("repo"))


def web_pages(pages: DataFrame, extracted: Column, fallback: Column | None = None, least: int = 100, most: int = 2000) -> DataFrame:
    """Pages whose text, or that of a fallback, has more than `least` characters."""
    text = F.when(F.length(extracted) > least, extracted)
    text = text if fallback is None else F.coalesce(text, fallback)
    return pages.withColumn("summary", F.left(text, F.lit(most))).where(F.length("summary") > least)


def plain_text(html: Column) -> Column:
    """Page text by built-in expressions: head, scripts, styles and navigation dropped, tags and white space reduced."""
    bare = F.regexp_replace(html, r"(?is)<(head|script|style|nav|header|footer|aside|form|noscript)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "<[^>]*>", " "), r"\s+", " "))


def article_records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landed articles that satisfy the contract, and those that do not."""
    raw = spark.read.schema(ARTICLE + ", _corrupt_record string").option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    good = F.col("url").isNotNull() & F.col("title").isNotNull() & F.col("source_id").isNotNull() & F.col("source_name").isNotNull() & F.col("source_type").isNotNull()
    return raw.where(F.coalesce(good, F.lit(False)) & F.col("_corrupt_record").isNull()).drop("_corrupt_record"), raw.where(~F.coalesce(good, F.lit(False)) | F.col("_corrupt_record").isNotNull())


def baseline(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A saved run: its metrics and its frozen articles."""
    return spark.read.option("multiLine", True).json(f"{folder}/metrics.json"), spark.read.schema(ARTICLE).option("multiLine", True).json(f"{folder}/raw-articles.json")


def config(path: str) -> dict:
    """A YAML or JSON configuration file; YAML needs the optional yaml package."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    import yaml

    return yaml.safe_load(text)


def configured_sources(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Configured sources with alias names resolved: type, url, active and default_category are other names."""
    alias = {"type": "connector", "url": "endpoint", "active": "enabled", "default_category": "category"}
    fields = ("id", "name", "connector", "endpoint", "category", "weight", "trust", "enabled", "query")
    tidy = []
    for row in rows:
        full = {alias.get(k, k): v for k, v in row.items()} | {k: v for k, v in row.items() if k in fields}
        tidy.append(tuple(full.get(f) for f in fields))
    return spark.createDataFrame(tidy, "id string, name string, connector string, endpoint string, category string, weight int, trust double, enabled boolean, query string")


def post_filtered(articles: DataFrame, as_of: Column, published: Column, max_age_days: int | None = None, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """A source's own filter: age (undated stays), then excluded words, then included patterns."""
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit("")))
    keep = F.lit(True) if max_age_days is None else published.isNull() | (times.age_days(as_of, published) <= max_age_days)
    return articles.where(keep & ~texts.excluded(text, exclude or []) & texts.included(text, include or []))
