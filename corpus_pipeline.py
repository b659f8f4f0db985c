"""The training-data pipeline: five stages over documents, each written as Parquet and read again.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the
columns of documents. n_chars is brought up to date where a stage changes a text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import langid, linededup, mixing, neardup, packing
from broadsheet.llm.shared import read, stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Documents are near copies from this Jaccard similarity on, in percent.
NEAR = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language can be told; null texts, and those without a letter or unlike all languages, go.

    Prototypes are learned from all labelled documents given. A text is unlike all languages if its score stays
    below langid.FLOOR, which a text that shares nothing with them reaches by chance in about 1 of 1000 cases a
    language. Texts of a few letters may stay below it, too. The lang column stays as it is.
    """
    prototypes = langid.train(docs)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields if f.name in COLUMNS}
    return langid.predict(docs.select(*COLUMNS), prototypes, kinds).where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= langid.FLOOR)).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of texts. A document that loses all its words goes with them."""
    cut = linededup.dedup_lines(docs.select(*COLUMNS))
    return cut.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with a _key of its own for each row: doc_id, or where ids are null or repeat, the row's place in their order, nulls last."""
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("doc_id IS NULL OR n > 1").isEmpty():
        return docs.select(*COLUMNS, F.col("doc_id").cast("long").alias("_key"))
    ordered = docs.select(*COLUMNS).orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text", "source"))
    return stage(ordered.withColumn("_key", F.monotonically_increasing_id()), "keyed")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (Jaccard similarity of NEAR percent or more), the one with the smallest id.

    Rows with a null id count as documents of their own, which come last; rows that repeat an id are compared like others.
    """
    rows = keyed(docs)
    groups = stage(neardup.near_duplicates(rows, "_key", percent=NEAR).where("_key <> component_id").select("_key"), "near-copies")
    return rows.join(groups, "_key", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents as the target weights of their sources ask; rows with a null or repeated id take copies of their own."""
    rows = keyed(docs)
    copies = stage(mixing.mix(rows, mixing.word_count(F.col("text")), "_key").where("copies > 0").select("_key", "copies"), "copies")
    # a merge join at every size: copies grow with the documents, so a broadcast would only serve small inputs
    return rows.join(copies.hint("merge"), "_key").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens: one row for each piece."""
    return packing.op4(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: SQL can express neither the language profiles nor the pivotal rounding; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents; every stage's rows are written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
