"""Run metrics: stage rollups, comparison of runs, annotation templates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.numbering import numbered


def stage_rollup(stages: DataFrame) -> DataFrame:
    """Stages (ord, name, n_in, n_out, elapsed_s) with what each dropped."""
    return stages.withColumn("dropped", F.col("n_in") - F.col("n_out")).orderBy("ord")


def run_summary(stages: DataFrame) -> DataFrame:
    return stages.agg(F.sum("elapsed_s").alias("total_elapsed_s"), F.max_by("n_out", "ord").alias("final_count"), F.count(F.lit(1)).alias("stages"))


def compared(baseline: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """Both runs' values by name, 0 where one lacks it, and the difference."""
    old, new = baseline.select(key, F.col(value).alias("baseline")), current.select(key, F.col(value).alias("current"))
    joined = old.join(new, key, "full_outer").select(key, F.coalesce("baseline", F.lit(0)).alias("baseline"), F.coalesce("current", F.lit(0)).alias("current"))
    return joined.withColumn("delta", F.col("current") - F.col("baseline"))


def annotation_template(articles: DataFrame, pos: str = "pos") -> DataFrame:
    """Articles numbered from 1 with empty columns for a reviewer's labels."""
    empty = {"valid": "boolean", "relevant": "boolean", "duplicate_of": "string", "same_event_as": "array<int>", "content_complete": "boolean", "source_trustworthy": "boolean", "notes": "string"}
    return numbered(articles, [pos], "id", 1).select("id", "url", "title", F.col("source_name").alias("source"), "category", F.col("priority_score").alias("score"), *[F.lit(None).cast(t).alias(n) for n, t in empty.items()])
