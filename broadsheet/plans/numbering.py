"""Consecutive numbers over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def numbered(rows: DataFrame, order: list[str], name: str = "pos", start: int = 0) -> DataFrame:
    """Adds a consecutive number by order, unique columns last for a fixed result.

    Rows are range-partitioned and written once; each part is numbered by itself and shifted by the sizes of the
    parts before it, a table of one row a part.
    """
    placed = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return placed.withColumn("_local", local).join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_local") + start).cast("long")).drop("_part", "_local", "_before")
