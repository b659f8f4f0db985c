"""A versioned table layer on Parquet: upsert, insert-or-ignore, patch, delete, and several tables in one commit.

A table's version is a folder; a store's state is one small manifest that names the current version of every
table. A commit writes new folders first and the manifest last, so readers see all of it or nothing. One writer.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# fixed values: the persistent tables, with key and columns
SCHEMAS = {
    "articles": ("url", "id string, url string, title string, summary string, published string, author string, source_id string, source_name string, category string, raw_extra string, first_seen string, week_bucket string"),
    "sources": ("id", "id string, name string, connector string, endpoint string, category string, weight int, trust double, active boolean, added_at string, last_seen string"),
    "events": ("id", "id string, week_label string, title string, summary string, category string, importance double, novelty double, impact double, final_score double, source_count long, created_at string"),
    "event_articles": ("event_id, article_url", "event_id string, article_url string"),
    "reports": ("id", "id string, week_label string, report_path string, event_count long, article_count long, generated_at string"),
    "report_events": ("report_id, event_id", "report_id string, event_id string"),
    "url_records": ("url", "url string, source_id string, first_seen timestamp, last_seen timestamp, last_fetched timestamp, etag string, last_modified string, content_hash string, status string, date_bucket string, metadata string"),
    "runtime_sources": ("id", "id string, canonical_url string, connector string, status string, enabled boolean, priority int, trust double, metadata string, articles_this_week int, streak_failures int, eval_score double, last_fetched string, last_success string"),
    "candidates": ("endpoint", "endpoint string, connector string, category string, discovered_via string, discovered_at string, score int, status string, details string, last_evaluated string"),
    "seen_urls": ("dedup_key", "dedup_key string, url string, first_seen string, date_bucket string"),
}
# end of fixed values


# ---- pure forms: old and new rows in, the next version out -------------------------------------------
def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by order, which is dropped."""
    packed = F.struct(*[c for c in rows.columns if c not in keys])
    return rows.groupBy(*keys).agg(F.max_by(packed, F.col(order)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rows.columns if c not in [*keys, order]])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = (), fill: tuple[str, ...] = (), action: bool = False) -> DataFrame:
    """New rows replace old ones of the same key. Columns in keep hold the old value, those in fill take a new one only if not null.

    New keys must be unique. With action, a column tells inserted, updated or kept.
    """
    values = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*values).alias("_o"))
    n = new.select(*keys, F.struct(*[F.col(c) if c in new.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in values]).alias("_n"))
    joined = o.join(n, keys, "full_outer")
    has_old, has_new = F.col("_o").isNotNull(), F.col("_n").isNotNull()

    def value(c: str) -> Column:
        mine, theirs = F.col("_o")[c], F.col("_n")[c]
        if c in keep:
            merged = F.when(has_old, mine).otherwise(theirs)
        elif c in fill or c not in new.columns:
            merged = F.coalesce(theirs, mine)
        else:
            merged = theirs
        return F.when(has_new, merged).otherwise(mine).alias(c)

    told = [F.when(~has_new, "kept").when(has_old, "updated").otherwise("inserted").alias("action")] if action else []
    return joined.select(*keys, *map(value, values), *told).select(*old.columns, *(["action"] if action else []))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows, and the new ones whose key is not there yet."""
    return old.unionByName(new.select(*old.columns).dropDuplicates(keys).join(old.select(*keys), keys, "left_anti"))


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def patch(old: DataFrame, changes: DataFrame, keys: list[str], allowed: tuple[str, ...]) -> DataFrame:
    """Sets whitelisted columns where changes has a row with a value; adds no rows."""
    columns = [c for c in changes.columns if c in allowed]
    joined = old.join(changes.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in columns]), keys, "left")
    return joined.withColumns({c: F.coalesce(f"_n_{c}", c) for c in columns}).select(*old.columns)


def delete_where(old: DataFrame, gone: Column) -> DataFrame:
    return old.where(~F.coalesce(gone, F.lit(False)))


def delete_keys(old: DataFrame, gone: DataFrame, on: list[str]) -> DataFrame:
    return old.join(gone.select(*on), on, "left_anti")


def delete_week(tables: dict[str, DataFrame], week: str) -> dict[str, DataFrame]:
    """events, reports and both bridges without a week's rows, bridges by the keys of what goes."""
    events, reports = tables["events"], tables["reports"]
    gone_events = events.where(F.col("week_label") == week).select(F.col("id").alias("event_id"))
    gone_reports = reports.where(F.col("week_label") == week).select(F.col("id").alias("report_id"))
    return {
        "event_articles": delete_keys(tables["event_articles"], gone_events, ["event_id"]),
        "report_events": delete_keys(tables["report_events"], gone_reports, ["report_id"]),
        "events": delete_where(events, F.col("week_label") == week),
        "reports": delete_where(reports, F.col("week_label") == week),
    }


def orphans(bridge: DataFrame, parent: DataFrame, on: str, key: str) -> DataFrame:
    """Bridge rows whose parent is missing: what a foreign key would have refused."""
    return bridge.join(parent.select(F.col(key).alias(on)), on, "left_anti")


# ---- the store ---------------------------------------------------------------------------------------
class Store:
    """Tables below a folder. Use as a context manager or not; nothing is held open."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def __enter__(self) -> Store:
        return self

    def __exit__(self, *_: object) -> None:
        return None

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def manifest(self) -> dict[str, str]:
        path, fs = self._path("_manifest.json")
        if not fs.exists(path):
            return {}
        stream = fs.open(path)
        try:
            return json.loads(str(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def read(self, table: str, schema: StructType | str | None = None) -> DataFrame:
        """The current version; an empty table of the known schema where there is none yet."""
        version = self.manifest().get(table)
        if version:
            return self.spark.read.parquet(f"{self.root}/{version}")
        return self.spark.createDataFrame([], schema or SCHEMAS[table][1])

    def commit(self, tables: dict[str, DataFrame], partition_by: dict[str, str] | None = None) -> dict[str, str]:
        """Writes all tables, then swaps the manifest. A failure before that leaves the old state."""
        state = self.manifest()
        for name, df in tables.items():
            version = f"{name}/v-{uuid.uuid4().hex}"
            writer = df.write
            if partition_by and name in partition_by:
                writer = writer.partitionBy(partition_by[name])
            writer.parquet(f"{self.root}/{version}")
            state[name] = version
        fresh, fs = self._path(f"_manifest-{uuid.uuid4().hex}.json")
        stream = fs.create(fresh, True)
        try:
            stream.write(bytearray(json.dumps(state).encode()))
        finally:
            stream.close()
        current, _ = self._path("_manifest.json")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(current.toUri() if current.toUri().getScheme() else self.spark._jvm.java.net.URI("file:///"), self.spark._jsc.hadoopConfiguration())
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fresh, current, options)
        return state


def persist_run(store: Store, sources: DataFrame, articles: DataFrame, events: DataFrame, links: DataFrame, week: str, report_path: str, now: str) -> dict[str, str]:
    """One run's rows into six tables in one commit. Running it again changes nothing but last_seen and generated_at.

    sources, articles and events are keyed and have pos, which decides which row of a key is last;
    links has event_id and article_url.
    """
    from ..functions.urls import report_id

    old_articles, old_events = store.read("articles"), store.read("events")
    new_sources = last_wins(sources.withColumns({"added_at": F.lit(now), "last_seen": F.lit(now)}), ["id"], "pos")
    new_articles = last_wins(articles.where(F.coalesce("url", F.lit("")) != "").withColumns({"first_seen": F.lit(now), "week_bucket": F.lit(week)}), ["url"], "pos")
    new_events = last_wins(events.withColumns({"created_at": F.lit(now), "week_label": F.lit(week)}), ["id"], "pos")
    all_events = upsert(old_events, new_events, ["id"], keep=("created_at", "week_label"))
    this_week = all_events.where(F.col("week_label") == week)
    spark = store.spark
    report = spark.range(1).select(report_id(F.lit(week)).alias("id"), F.lit(week).alias("week_label"), F.lit(report_path).alias("report_path"))
    counts = links.select("event_id", "article_url").distinct().agg(F.count(F.lit(1)).alias("article_count"), F.count_distinct("event_id").alias("event_count"))
    report = report.crossJoin(counts).withColumn("generated_at", F.lit(now))  # one row and one row
    return store.commit(
        {
            "sources": upsert(store.read("sources"), new_sources, ["id"], keep=("added_at",)),
            "articles": upsert(old_articles, new_articles, ["url"], keep=("first_seen",)),
            "events": all_events,
            "event_articles": insert_ignore(store.read("event_articles"), links, ["event_id", "article_url"]),
            "reports": upsert(store.read("reports"), report, ["id"]),
            "report_events": insert_ignore(store.read("report_events"), this_week.select(report_id(F.lit(week)).alias("report_id"), F.col("id").alias("event_id")), ["report_id", "event_id"]),
        }
    )
