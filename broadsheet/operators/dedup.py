"""Hard deduplication by URL, change detection, and semantic deduplication by similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times, urls
from ..plans.lineage import cut


def first_wins(rows: DataFrame, key: str, order: str = "pos") -> DataFrame:
    """The first row of each key. An aggregate, not a window: a frequent key is reduced map-side."""
    packed = F.struct(*[F.col(c) for c in [order, *[c for c in rows.columns if c != order]]])
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min_by(packed, F.col(order)).alias("_row")).select(*[F.col("_row")[c].alias(c) for c in rows.columns])


def hard_dedup(articles: DataFrame, registry: DataFrame | None = None, url: str = "url", order: str = "pos") -> DataFrame:
    """Articles with a URL that neither an earlier article of the batch nor the registry (url) has."""
    fresh = first_wins(articles.where(F.coalesce(F.col(url), F.lit("")) != ""), url, order)
    return fresh if registry is None else fresh.join(registry.select(url), url, "left_anti")


def seen_again(articles: DataFrame, registry: DataFrame, url: str = "url") -> DataFrame:
    return articles.join(registry.select(url), url, "left_semi")


def day_dedup(rows: DataFrame, url: Column, ts: Column, order: str) -> DataFrame:
    """The first row of each URL and day; the same URL counts anew the next day."""
    return first_wins(rows.withColumn("dedup_key", urls.dedup_key(url, times.day_bucket(ts))), "dedup_key", order)


def change_detection(versions: DataFrame, key: str, ts: str, value_hash: str) -> DataFrame:
    """Each sighting of a key with first_seen, the previous hash, and status new, seen_again or changed."""
    seen = Window.partitionBy(key).orderBy(ts, value_hash)
    before = F.lag(value_hash).over(seen)
    status = F.when(F.row_number().over(seen) == 1, "new").when(before != F.col(value_hash), "changed").otherwise("seen_again")
    return versions.withColumn("previous_hash", before).withColumn("first_seen", F.min(ts).over(seen)).withColumn("status", status)


def registered(registry: DataFrame, batch: DataFrame, as_of: Column) -> DataFrame:
    """The URL registry after a batch of (url, source_id, title, summary): new rows, and known ones seen again.

    A known URL keeps first_seen, source and day bucket; its hash, last_seen and status change.
    registry has url, source_id, first_seen, last_seen, content_hash, status, date_bucket.
    """
    fresh = first_wins(batch, "url").select("url", F.col("source_id").alias("n_source"), urls.content_hash(F.col("url"), F.col("title"), F.col("summary")).alias("n_hash"))
    both = registry.join(fresh, "url", "full_outer")
    known, now = F.col("first_seen").isNotNull(), F.col("n_hash").isNotNull()
    return both.select(
        "url",
        F.coalesce("source_id", "n_source").alias("source_id"),
        F.coalesce("first_seen", as_of).alias("first_seen"),
        F.when(now, as_of).otherwise(F.col("last_seen")).alias("last_seen"),
        F.coalesce("n_hash", "content_hash").alias("content_hash"),
        F.when(known & now, F.lit("seen_again")).when(known, F.col("status")).otherwise(F.lit("new")).alias("status"),
        F.coalesce("date_bucket", times.day_bucket(as_of)).alias("date_bucket"),
        (known & now & (F.coalesce("content_hash", F.lit("")) != F.col("n_hash"))).alias("changed"),
    )


def expired(registry: DataFrame, as_of: Column, keep_days: int = 30) -> DataFrame:
    """The registry without URLs last seen more than keep_days ago."""
    return registry.where(F.col("last_seen") >= as_of - F.make_dt_interval(F.lit(keep_days)))


# ---- similarity ------------------------------------------------------------------------------------
def similar_pairs(vectors: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 2048, strict: bool = True) -> DataFrame:
    """(a, b, similarity) with a < b for all pairs whose cosine exceeds the threshold (strict) or reaches it.

    Rows are dealt to blocks by a hash of their id; every pair of blocks is one task's matrix product.
    Zero vectors are similar to nothing.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    blocks = max(1, -(-rows.count() // block))
    own = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def product(group: pd.DataFrame) -> pd.DataFrame:
        matrix = np.stack(group["v"].to_numpy()).astype(np.float64)
        lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = np.where(lengths < 1e-10, 0.0, matrix / np.maximum(lengths, 1e-10))
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        left = np.flatnonzero((group["own"] == i).to_numpy())
        right = np.flatnonzero((group["own"] == j).to_numpy())
        ids, out = group["id"].to_numpy(), []
        for start in range(0, len(left), 512):
            part = left[start : start + 512]
            found = matrix[part] @ matrix[right].T
            x, y = np.nonzero(found > threshold if strict else found >= threshold)
            a, b = ids[part[x]], ids[right[y]]
            keep = a < b if i == j else a != b
            out.append(pd.DataFrame({"a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep], "similarity": found[x, y][keep]}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "similarity": []})

    return dealt.groupBy("i", "j").applyInPandas(product, "a long, b long, similarity double")


def greedy_kept(ids: DataFrame, pairs: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids kept when rows are taken in order and one that is similar to an earlier kept row is dropped.

    Rounds over the edges: a row with no undecided or kept earlier neighbour is kept, one with a kept earlier
    neighbour is dropped, until none is undecided. Ids without an edge never enter a round.
    """
    edges = cut(pairs.select("a", "b"))
    linked = edges.select(F.col("a").alias(id_col)).union(edges.select(F.col("b").alias(id_col))).distinct()
    free = ids.select(id_col).join(linked, id_col, "left_anti")
    open_, kept = cut(linked), []
    while not open_.isEmpty():  # each round settles the first open row at least
        inner = edges.join(open_.select(F.col(id_col).alias("b")), "b", "left_semi")
        now = cut(open_.join(inner.select(F.col("b").alias(id_col)), id_col, "left_anti"))
        kept.append(now)
        if len(kept) == 50:  # one table, so that the plan of the union stays small
            kept = [cut(reduce(DataFrame.unionByName, kept))]
        dropped = edges.join(now.select(F.col(id_col).alias("a")), "a", "left_semi").select(F.col("b").alias(id_col))
        open_ = cut(open_.join(now, id_col, "left_anti").join(dropped, id_col, "left_anti"))
        edges = cut(edges.join(open_.select(F.col(id_col).alias("a")), "a", "left_semi").join(open_.select(F.col(id_col).alias("b")), "b", "left_semi"))
    found = free
    for more in kept:
        found = found.unionByName(more)
    return found


def semantic_dedup(vectors: DataFrame, threshold: float = 0.85, id_col: str = "vec_id", vector_col: str = "embedding", strict: bool = True) -> DataFrame:
    """Rows kept by greedy deduplication in id order."""
    pairs = similar_pairs(vectors, threshold, id_col, vector_col, strict=strict)
    kept = greedy_kept(vectors.select(F.col(id_col).cast("long").alias("id")), pairs)
    return vectors.join(kept.select(F.col("id").alias(id_col)), id_col, "left_semi")


def embedded(rows: DataFrame, text: Column, embed, dimensions: int) -> DataFrame:
    """Adds `embedding` by a provider: embed(list of texts) -> array (n, dimensions), called once per Arrow batch."""
    schema = rows.withColumn("embedding", F.array().cast("array<float>")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["embedding"] = list(np.asarray(embed(frame["_text"].tolist()), np.float32).reshape(-1, dimensions)) if len(frame) else []
            yield frame.drop(columns="_text")

    return rows.withColumn("_text", text).mapInPandas(run, schema)
