"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after lower-casing A-Z. A first scan takes each text's length and the hash of
its first bytes; lengths that occur once, then (length, prefix hash) pairs that occur once, are settled. The
surviving pairs set bits in a bitmap of fixed size, which is broadcast: a second scan hashes the full
content of the texts whose bit is set, and only these are grouped. A bit set by another pair costs a hash
and changes no result. DataFrame functions only.

Nulls: a null text equals an empty one. Among equal texts the largest id stays; rows that repeat that id with
the same text are alike and are all marked kept. An empty table gives an empty result. Hot groups are
counted map-side first, and their rows meet their group in a join that AQE can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import lower_ascii, stage

#: Bytes of the prefix, and the words of 64 bits that the broadcast bitmap has at most: one MB as rows.
PREFIX, WORDS = 64, 1 << 16


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def _bit(n: Column, p: Column) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(n, p), F.lit(WORDS * 64))
    return F.floor(at / 64).cast("int"), (at % 64).cast("int")


def survivors(keys: DataFrame) -> DataFrame:
    """The bitmap, (word, mask), of (n, p) pairs that more than one row of keys has; at most WORDS rows."""
    lengths = keys.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("n")
    pairs = keys.groupBy("n", "p").agg(F.count(F.lit(1)).alias("rows")).join(lengths, "n", "left_semi").where("rows > 1")
    word, bit = _bit(F.col("n"), F.col("p"))
    return pairs.select(word.alias("word"), F.expr("1L").alias("one"), bit.alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("mask"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """One row for each input row: the id, keep_id, group_size, kept and the carried expressions over the input's columns."""
    carry = carry or {}
    text = normalised(F.col(text_col))
    source = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), *[c.alias(n) for n, c in carry.items()])
    measured = source.select("*", F.octet_length("_text").alias("n"), F.xxhash64(F.substring(F.encode("_text", "UTF-8"), 1, PREFIX)).alias("p"))
    bitmap = stage(survivors(stage(measured.select("n", "p"), "prefixes")), "bitmap")

    word, bit = _bit(F.col("n"), F.col("p"))
    marked = measured.withColumn("word", word).withColumn("bit", bit).join(F.broadcast(bitmap), "word", "left")
    again = F.coalesce(F.expr("getbit(mask, bit)"), F.lit(0)) == 1
    rows = stage(marked.select("_id", *carry, F.when(again, F.sha2(F.col("_text"), 256)).alias("full")), "hashed")

    hashed = rows.where("full IS NOT NULL")
    groups = stage(hashed.groupBy("full").agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "groups")
    repeated = hashed.join(groups, "full", "left").select("_id", F.coalesce("keep_id", "_id").alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), *carry)
    single = rows.where("full IS NULL").select("_id", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), *carry)
    return repeated.unionByName(single).select(F.col("_id").alias(id_col), "keep_id", "group_size", F.coalesce(F.col("_id") == F.col("keep_id"), F.lit(False)).alias("kept"), *carry)


def op7(docs: DataFrame) -> DataFrame:
    return exact_dedup(docs, carry={"text_sha256": F.sha2(normalised(F.col("text")), 256)})


OP7_SQL = """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
