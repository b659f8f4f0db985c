"""Model calls as a table function: batches of rows to replies by an injected provider, parsing left to expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import texts
from ..plans.numbering import numbered

REPLY = "event_index int, is_relevant boolean, event_title string, event_summary string, category string, importance double, novelty double, impact double, key_insights array<string>, tags array<string>, top_articles array<int>, evidence_articles array<int>"


def batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    """Adds batch_id and event_index: consecutive rows in groups of size."""
    return numbered(rows, [order], "_at").withColumn("batch_id", F.floor(F.col("_at") / size)).withColumn("event_index", (F.col("_at") % size).cast("int")).drop("_at")


def ask(prompts: DataFrame, chat: Callable[[str, str], str], system: str) -> DataFrame:
    """(batch_id, reply) of (batch_id, prompt); a failed call is a null reply."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            replies = []
            for prompt in frame["prompt"]:
                try:
                    replies.append(chat(system, prompt))
                except Exception:  # a provider's failure of any kind leaves the row to its fallback
                    replies.append(None)
            yield pd.DataFrame({"batch_id": frame["batch_id"], "reply": replies})

    return prompts.select("batch_id", "prompt").mapInPandas(run, "batch_id long, reply string")


def replies(answered: DataFrame, schema: str = REPLY) -> DataFrame:
    """One row for each object of every parsable reply."""
    return answered.select("batch_id", F.explode(texts.parsed(F.col("reply"), schema)).alias("r")).select("batch_id", "r.*")


def cached(rows: DataFrame, cache: DataFrame, prompt_hash: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with a cached result by the hash of prompt version, title and summary, and rows without one."""
    keyed = rows.withColumn("cache_key", F.sha2(F.concat(prompt_hash, F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit(""))), 256))
    return keyed.join(cache, "cache_key"), keyed.join(cache.select("cache_key"), "cache_key", "left_anti")


def pairwise_rerank(rows: DataFrame, group: str, rank: str, k: int, better: Callable[[Column, Column], Column], columns: tuple[str, ...]) -> DataFrame:
    """Re-ranks each group's top k by wins in all their pairs; k is small, ties keep the old order."""
    top = rows.where(F.col(rank) <= k).groupBy(group).agg(F.sort_array(F.collect_list(F.struct(rank, *columns))).alias("_top"))
    wins = F.transform("_top", lambda x: F.struct(x.alias("row"), F.size(F.filter("_top", lambda y: (y[rank] != x[rank]) & better(x, y))).alias("wins")))
    out = top.select(group, F.explode(wins).alias("w")).select(group, "w.row.*", F.col("w.wins").alias("wins"))
    return out.withColumn("new_rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("wins"), rank)))


def discovered(reply_lines: DataFrame, text: str = "reply") -> DataFrame:
    """Sources named line by line in a reply: JSON objects with a url, or bare addresses."""
    lines = reply_lines.select(F.explode(F.split(text, "\n")).alias("line")).select(F.trim("line").alias("line")).where("line <> ''")
    got = F.from_json("line", "url string, name string, category string")
    url = F.coalesce(got["url"], F.when(F.col("line").startswith("http"), F.col("line")))
    return lines.select(url.alias("endpoint"), F.coalesce(got["name"], F.regexp_extract(url, "^https?://([^/]+)", 1)).alias("name"), got["category"].alias("category")).where(F.col("endpoint").startswith("http"))
