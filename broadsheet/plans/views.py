"""Article, event and link views over the driver tables, in DataFrame form and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The clock of all queries.
AS_OF = "2024-01-31 00:00:00"
CATEGORIES = ("LLM", "Agent", "Simulation", "CAD")


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    text, seconds = F.col("text"), (F.col("doc_id") % 28) * 86400 + (F.col("doc_id") % 24) * 3600
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("pos"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.left(F.md5(text), F.lit(12))).alias("url"),
        F.left(text, F.lit(80)).alias("title"),
        text.alias("summary"),
        F.concat(F.lit("web:"), F.col("source")).alias("source_id"),
        F.col("source").alias("source_name"),
        F.when(F.col("lang") == "en", "LLM").when(F.col("lang") == "fr", "Agent").when(F.col("lang") == "de", "Simulation").otherwise("CAD").alias("category"),
        F.when(F.col("quality") == 1, 8).when(F.col("quality") == 0, 3).otherwise(5).alias("priority_score"),
        F.timestamp_seconds(F.lit(1704067200) + seconds).alias("published"),
    )


def with_event(rows: DataFrame) -> DataFrame:
    """Articles of one source, category and third of the month form an event."""
    return rows.withColumn("event_id", F.concat_ws("|", "source_name", "category", F.floor(F.dayofmonth("published") / 10).cast("string")))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")


ARTICLES_SQL = """articles AS (
  SELECT d.doc_id AS pos, 'https://' || d.source || '.example.com/' || left(md5(d.text), 12) AS url, left(d.text, 80) AS title, left(d.text, 2000) AS summary,
         'web:' || d.source AS source_id, d.source AS source_name,
         CASE d.lang WHEN 'en' THEN 'LLM' WHEN 'fr' THEN 'Agent' WHEN 'de' THEN 'Simulation' ELSE 'CAD' END AS category,
         CASE l.quality WHEN 1 THEN 8 WHEN 0 THEN 3 ELSE 5 END AS priority_score,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds((d.doc_id % 28) * 86400 + (d.doc_id % 24) * 3600) AS published
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
grouped AS (SELECT *, source_name || '|' || category || '|' || CAST(floor(day(published) / 10) AS INTEGER) AS event_id FROM articles)"""
