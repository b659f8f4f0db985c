"""Connector metadata and routing, and landed files as a Python data source."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# fixed values: the connectors, the platform each serves and its priority
CONNECTORS = [("rss", "RSS and Atom feeds", 100), ("arxiv", "Paper archive", 90), ("github", "Releases and trending", 80), ("exa_search", "Search results", 60), ("web", "Web pages", 50)]
# end of fixed values


def connectors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONNECTORS, "name string, description string, priority int").orderBy(F.desc("priority"), "name")


def routed(connector: Column, default: str = "rss") -> Column:
    """The connector itself if it is known, else the default."""
    return F.when(connector.isin(*[c[0] for c in CONNECTORS]), connector).otherwise(F.lit(default))


class LandedArticles(DataSource):
    """Articles in JSON-lines files of a folder, one partition a file: format `landed_articles`, option `path`."""

    @classmethod
    def name(cls) -> str:
        return "landed_articles"

    def schema(self) -> str:
        return "url string, title string, summary string, published string, source_name string"

    def reader(self, schema: object) -> DataSourceReader:
        return _LandedReader(self.options["path"])


class _LandedReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(str(p)) for p in sorted(Path(self.path).glob("*.jsonl"))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(partition.value, encoding="utf-8") as lines:
            for line in lines:
                row = json.loads(line)
                yield tuple(row.get(k) for k in ("url", "title", "summary", "published", "source_name"))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedArticles)
