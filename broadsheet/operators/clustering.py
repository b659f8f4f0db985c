"""Clustering of vectors within buckets: online average linkage and density clusters, with their quality measures."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions import texts
from ..plans.lineage import cut
from ..plans.numbering import numbered


def _vectors(frame: pd.DataFrame, column: str) -> np.ndarray:
    matrix = np.stack(frame[column].to_numpy()).astype(np.float64)
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-10)


def linkage_labels(matrix: np.ndarray, threshold: float) -> np.ndarray:
    """Rows in order join the cluster with the smallest mean squared distance if it is at most 2 (1 - threshold).

    On unit vectors that is the largest mean cosine, so a cluster is its sum and size. The first wins a tie.
    """
    sums, counts = np.zeros_like(matrix), np.zeros(len(matrix))
    labels, made = np.empty(len(matrix), np.int64), 0
    for i, row in enumerate(matrix):
        mean = np.round(sums[:made] @ row / counts[:made], 12) if made else np.empty(0)
        best = int(mean.argmax()) if made else -1
        if made == 0 or mean[best] < threshold:
            best, made = made, made + 1
        sums[best] += row
        counts[best] += 1
        labels[i] = best
    return labels


def online_linkage(rows: DataFrame, bucket: str, id_col: str, vector_col: str, threshold: float = 0.5) -> DataFrame:
    """(bucket, id, cluster). The algorithm is sequential, so its unit of work is a bucket; choose buckets that fit a task."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", ignore_index=True)
        return pd.DataFrame({"bucket": frame["bucket"], "id": frame["id"], "cluster": linkage_labels(_vectors(frame, "v"), threshold)})

    kind = dict(rows.dtypes)[bucket]
    return rows.select(F.col(bucket).alias("bucket"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).groupBy("bucket").applyInPandas(run, f"bucket {kind}, id long, cluster long")


def density_labels(matrix: np.ndarray, least: int = 2, reach: float = 0.6) -> np.ndarray:
    """Density clusters (DBSCAN over cosine distance) of vectors that fit a task: -1 is noise. Labels follow the first member's order."""
    near = 1 - matrix @ matrix.T <= reach
    core = near.sum(axis=1) >= least
    labels, made = np.full(len(matrix), -1), 0
    for i in np.flatnonzero(core):
        if labels[i] >= 0:
            continue
        front = [int(i)]
        labels[i] = made
        while front:
            at = front.pop()
            fresh = np.flatnonzero(near[at] & (labels < 0))
            labels[fresh] = made
            front += [int(x) for x in fresh if core[x]]
        made += 1
    return labels


def _spanning(near: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of a bipartite graph as its edges (row, column): as many as nodes at most, however dense the graph is."""
    rows, columns = [], []
    turned = np.ascontiguousarray(near.T)
    fresh_rows, fresh_columns = near.any(axis=1), near.any(axis=0)
    for first in np.flatnonzero(fresh_rows):
        if not fresh_rows[first]:
            continue
        fresh_rows[first] = False
        front = [(True, int(first))]
        while front:
            is_row, at = front.pop()
            found = np.flatnonzero(near[at] & fresh_columns if is_row else turned[at] & fresh_rows)
            (fresh_columns if is_row else fresh_rows)[found] = False
            there = found.tolist()
            rows += [at] * len(there) if is_row else there
            columns += there if is_row else [at] * len(there)
            front += [(not is_row, x) for x in there]
    return rows, columns


def _components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b), the root being the smallest node reachable.

    Each round every node takes its smallest neighbour as parent, parents are followed to their roots by doubling,
    and the edges between different roots are the next round's graph, so rounds grow with the logarithm of the nodes.
    """
    graph = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = cut(graph.select(F.col("a").alias("node")).unionByName(graph.select(F.col("b").alias("node"))).distinct()).select("node", F.col("node").alias("root"))
    graph = graph.where("a <> b")
    while not graph.isEmpty():
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up")))
        while True:
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = cut(parents.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") < F.col("up")).alias("moved")))
            parents = jumped.select("node", "up")
            if jumped.where("moved").isEmpty():
                break
        roots = cut(roots.join(parents.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root")))
        left = graph.join(parents.withColumnRenamed("node", "a"), "a").select(F.col("up").alias("a"), "b")
        ends = left.join(parents.withColumnRenamed("node", "b"), "b").select("a", F.col("up").alias("b")).where("a <> b")
        graph = cut(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return roots


def density_clusters(rows: DataFrame, bucket: str, id_col: str, vector_col: str, least: int = 2, reach: float = 0.6, block: int = 4096) -> DataFrame:
    """(bucket, id, cluster, noise): noise rows get clusters of their own, numbered after all others.

    The labels are those of density_labels over a whole bucket, but no task holds more than two blocks of it. Rows are
    dealt to blocks by a hash, and every pair of blocks of a bucket is one task's matrix product, computed twice: first
    it counts neighbours, which tells the core rows, then it links core rows by a spanning forest (one edge a row at
    most) and names the core neighbours of the others, fewer than `least` each. Clusters are the components of the
    core rows; a row between several joins the one that begins first.

    The stand-in for topic clustering with models that are not shipped; labels are not comparable with theirs.
    """
    named = rows.select(F.col(bucket).alias("bucket"), F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    base = cut(numbered(named, ["bucket", "id"], "node"))
    sizes = base.groupBy(F.col("bucket").alias("_bucket")).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = base.join(sizes, F.col("bucket").eqNullSafe(F.col("_bucket"))).drop("_bucket", "id").withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))

    def pairs(these: DataFrame) -> GroupedData:
        spread = these.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return spread.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).groupBy("bucket", "i", "j")

    def close(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the rows of either block, and which of them are near each other."""
        matrix, own = _vectors(group, "v"), group["own"].to_numpy()
        left, right = np.flatnonzero(own == group["i"].iloc[0]), np.flatnonzero(own == group["j"].iloc[0])
        near = np.empty((len(left), len(right)), bool)
        for start in range(0, len(left), 512):
            part = slice(start, start + 512)
            near[part] = 1 - matrix[left[part]] @ matrix[right].T <= reach
        return left, right, near

    def count(group: pd.DataFrame) -> pd.DataFrame:
        left, right, near = close(group)
        nodes, n = group["node"].to_numpy()[left], near.sum(axis=1)
        if group["i"].iloc[0] != group["j"].iloc[0]:
            nodes, n = np.concatenate([nodes, group["node"].to_numpy()[right]]), np.concatenate([n, near.sum(axis=0)])
        return pd.DataFrame({"node": nodes, "n": n})[n > 0]

    def link(group: pd.DataFrame) -> pd.DataFrame:
        left, right, near = close(group)
        nodes, core = group["node"].to_numpy(), group["core"].to_numpy()
        x, y = _spanning(near & core[left][:, None] & core[right])
        edge_of, edge_by = np.nonzero(near & ~core[left][:, None] & core[right])
        edge_by_2, edge_of_2 = np.nonzero(near & core[left][:, None] & ~core[right])
        a = np.concatenate([left[x], left[edge_of], right[edge_of_2]]).astype(np.int64)
        b = np.concatenate([right[y], right[edge_by], left[edge_by_2]]).astype(np.int64)
        return pd.DataFrame({"a": nodes[a], "b": nodes[b], "inner": core[a]})

    counted = pairs(dealt).applyInPandas(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
    counted = cut(counted.select("node", (F.col("n") >= least).alias("core"), (F.col("n") > 1).alias("linked")))
    edges = cut(pairs(dealt.join(counted.where("linked").select("node", "core"), "node")).applyInPandas(link, "a long, b long, inner boolean"))
    roots = _components(edges.where("inner").select("a", "b"))
    inner = counted.where("core").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    outer = edges.where("NOT inner").select(F.col("a").alias("edge"), F.col("b").alias("node")).join(inner, "node").groupBy(F.col("edge").alias("node")).agg(F.min("root").alias("root"))
    placed = base.select("bucket", "id", "node").join(inner.unionByName(outer), "node", "left")
    placed = cut(placed.select("bucket", "id", F.coalesce("root", "node").alias("root"), F.col("root").isNull().alias("noise")))
    heads = cut(numbered(placed.select("bucket", "noise", "root").distinct(), ["bucket", "noise", "root"], "n"))
    first = heads.groupBy(F.col("bucket").alias("_bucket")).agg(F.min("n").alias("first"))
    labels = heads.join(first, F.col("bucket").eqNullSafe(F.col("_bucket"))).select("root", (F.col("n") - F.col("first")).alias("cluster"))
    return placed.join(labels, "root").select("bucket", "id", "cluster", "noise")


def bucketed(articles: DataFrame, source_name: str = "source_name") -> DataFrame:
    return articles.withColumn("bucket", F.when(texts.is_academic(F.col(source_name)), F.lit("academic")).otherwise(F.lit("social")))


def clustered(articles: DataFrame, vector_col: str = "embedding", id_col: str = "pos", dedup_at: float = 0.85, link_at: float = 0.5) -> DataFrame:
    """Articles with bucket and cluster: semantic deduplication, split by kind of source, linkage for one, density for the other."""
    from .dedup import semantic_dedup

    kept = cut(bucketed(semantic_dedup(articles, dedup_at, id_col, vector_col)))
    academic = online_linkage(kept.where("bucket = 'academic'"), "bucket", id_col, vector_col, link_at)
    social = density_clusters(kept.where("bucket = 'social'"), "bucket", id_col, vector_col).drop("noise")
    return kept.join(academic.unionByName(social).withColumnRenamed("id", id_col), ["bucket", id_col])


def quality(labelled: DataFrame, truth: str = "truth", cluster: str = "cluster") -> DataFrame:
    """Per labelled event: size, its best cluster's size, true and false positives, misses, precision, recall and F1.

    The best cluster shares most members; the smaller cluster number wins a tie.
    """
    both = labelled.where(F.col(truth).isNotNull()).groupBy(truth, cluster).agg(F.count(F.lit(1)).alias("tp"))
    size = labelled.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"))
    gt = labelled.where(F.col(truth).isNotNull()).groupBy(truth).agg(F.count(F.lit(1)).alias("gt_size"))
    best = both.groupBy(truth).agg(F.max_by(F.struct(cluster, "tp"), F.struct("tp", -F.col(cluster))).alias("b")).select(truth, F.col(f"b.{cluster}").alias(cluster), "b.tp")
    rows = best.join(size, cluster).join(gt, truth).withColumn("fp", F.col("cluster_size") - F.col("tp")).withColumn("fn", F.col("gt_size") - F.col("tp"))
    return rows.select(truth, "gt_size", "cluster_size", "tp", "fp", "fn", *_measures())


def _measures() -> list:
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / (F.col("tp") + F.col("fn"))
    return [F.round(precision, 4).alias("prec"), F.round(recall, 4).alias("rec"), F.round(F.when(F.col("tp") == 0, 0.0).otherwise(2 * precision * recall / (precision + recall)), 4).alias("f1")]


def overall(per_event: DataFrame) -> DataFrame:
    return per_event.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")]).select("tp", "fp", "fn", *_measures())
