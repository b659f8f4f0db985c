"""Helpers that several operators share: tables in the shared folder and Arrow plumbing."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words in every contract: space and the bytes 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

_own_folder: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; one of our own only where that is unset and all run on this machine."""
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = context.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="broadsheet-")
    return _own_folder[app]


def folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, among those that release() deletes."""
    return f"{scratch_root(spark)}/broadsheet/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Writes df to a table in the shared folder and reads it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and later joins see file statistics, so that AQE can split skewed partitions.
    """
    spark = df.sparkSession
    path = folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Deletes every table this application staged. Call it once no result is read any more."""
    delete(spark, f"{scratch_root(spark)}/broadsheet/{spark.sparkContext.applicationId}")


_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]) -> object:
    """What an operator keeps in a Python worker across its tasks. A worker holds one such thing: another key drops the last."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20, most_rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that one piece holds about most_bytes of a text column; a longer single row stays whole."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for at, n in enumerate(sizes):
            n = n or 0
            if at > start and (held + n > most_bytes or at - start >= most_rows):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only. Text of one byte a character takes the fast built-in."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def hash128(key: Column) -> list[Column]:
    """Two independent 64-bit hashes of a column, named h1 and h2."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("b"), key, F.lit("s")).alias("h2")]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
