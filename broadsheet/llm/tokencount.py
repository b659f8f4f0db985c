"""Token counts by a map-side two-tier lookup, without moving a pre-token between tasks.

First, every task counts the pre-tokens of its own texts in a bounded heavy-hitter summary; the summaries,
at most SUMMARY entries each, are added up, and the FREQUENT most frequent pre-tokens are encoded
once and sent to all tasks as a compact table of lengths. Then every text's pre-tokens are looked up there;
what is missing is encoded by the worker and kept in its cache, which is bounded in bytes and outlives a task. Counts are the library's in every case: the
table and the caches only save work.

Nulls: a null text is empty and has 0 tokens. Long texts are read whole. Repeated rows are each counted.
Ties among frequent pre-tokens go by the token itself. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pretokens import PreTokens, kept
from .shared import slices

#: Entries of a task's summary, and of the table sent to all tasks: at most 64 bytes each.
SUMMARY, FREQUENT = 2048, 8192
TOKENIZER, LIMIT = "word_bpe_49k.json", 2048


def _prune(counts: Counter, most: int) -> Counter:
    """Misra-Gries: keeps the most frequent entries, each less the largest count that goes."""
    top = counts.most_common(most + 1)
    if len(top) <= most:
        return counts
    cut = top[-1][1]
    return Counter({k: n - cut for k, n in top if n > cut})


def frequent(docs: DataFrame, text_col: str = "text", path: str = "", kind: str = "word", summary: int = SUMMARY, most: int = FREQUENT) -> list[str]:
    """The pre-tokens that all texts have most often, by the tasks' summaries; ties by code point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (rule, _), counts = kept(path, kind, lambda r, token: 0, "none"), Counter()
        for batch in slices(batches, "text", 1 << 20):
            for text in batch.column("text").to_pylist():
                tokens = rule.split(text)
                if tokens is not None:
                    counts.update(tokens)
            if len(counts) > 32 * summary:
                counts = _prune(counts, 8 * summary)
        top = sorted(((k, n) for k, n in counts.items() if len(k) <= 64), key=lambda x: (-x[1], x[0]))[:summary]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["token", "n"])

    found = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL").mapInArrow(run, "token string, n long")
    top = found.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "token").limit(most)
    return [row.token for row in top.collect()]


def lengths(tokens: list[str], path: str, kind: str = "word") -> dict[str, int]:
    rule = PreTokens(path, kind)
    return {token: len(rule.piece(token)) for token in tokens}


def count_tokens(docs: DataFrame, keep: dict[str, str], text_col: str = "text", path: str = "", kind: str = "word") -> DataFrame:
    """Adds n_bytes and n_tokens to the columns in keep (name to type). path: a tokenizers file on every machine."""
    path = path or public_tokenizers.path(TOKENIZER)
    spark, names = docs.sparkSession, list(keep)
    table = spark.sparkContext.broadcast(lengths(frequent(docs, text_col, path, kind), path, kind))
    run_id = f"lengths-{uuid.uuid4().hex}"  # a worker takes up the table that was sent to it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, cache = kept(path, kind, lambda r, token: len(r.piece(token)), run_id, table.value)
        look = cache.__getitem__
        for batch in slices(batches, "text"):
            counts, sizes = [], []
            for text in batch.column("text").to_pylist():
                text = text or ""
                tokens = rule.split(text)
                counts.append(sum(map(look, tokens)) if tokens is not None else len(rule.ids(text)))
                sizes.append(len(text.encode()))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=[*names, "n_bytes", "n_tokens"])

    inputs = [F.col(n) for n in names] + [F.col(text_col).alias("text")] * ("text" not in names)
    return docs.select(*inputs).mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in keep.items()), "n_bytes long, n_tokens long"]))


def op3(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    return count_tokens(docs, {"doc_id": "long"}).withColumn("over_limit", F.col("n_tokens") > limit)
