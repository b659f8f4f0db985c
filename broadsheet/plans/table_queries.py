"""Queries of the table layer, the report's joins and the streaming forms."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import registry
from ..sources import tables as tb
from ..streaming import state
from .catalog import query
from .lineage import shared_folder
from .views import ARTICLES_SQL, articles, table


def _bridge(spark, sf_dir):
    o, li, s = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "supplier"))
    events = o.select(F.col("o_orderkey").alias("event_id"), F.col("o_orderstatus").alias("status"))
    bridge = li.select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("article_url"), F.col("l_suppkey").alias("source_id"))
    arts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("url"), "p_brand", (F.col("p_partkey") % 100).alias("source_id"))
    return events, bridge, arts, s.select(F.col("s_suppkey").alias("source_id"), "s_name")


@query("""SELECT e.o_orderkey AS event_id, b.l_partkey AS article_url, p.p_brand, s.s_name FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') e JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b ON b.l_orderkey = e.o_orderkey
JOIN part p ON p.p_partkey = b.l_partkey LEFT JOIN supplier s ON s.s_suppkey = p.p_partkey % 100""")
def evidence_chain(spark, sf_dir):
    events, bridge, arts, sources = _bridge(spark, sf_dir)
    return ev.evidence_chain(events.where("status = 'F'"), bridge, arts, sources).select("event_id", "article_url", "p_brand", "s_name")


@query("SELECT b.l_orderkey AS event_id, count(*) AS articles, count(DISTINCT p.p_brand) AS brands FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b JOIN orders o ON o.o_orderkey = b.l_orderkey JOIN part p ON p.p_partkey = b.l_partkey GROUP BY 1")
def event_article_counts(spark, sf_dir):
    events, bridge, arts, _ = _bridge(spark, sf_dir)
    return ev.event_articles(events, bridge, arts).groupBy("event_id").agg(F.count(F.lit(1)).alias("articles"), F.count_distinct("p_brand").alias("brands"))


@query(f"""WITH {ARTICLES_SQL} SELECT url, pos, source_name FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos DESC) AS r FROM articles) WHERE r = 1""")
def last_wins(spark, sf_dir):
    return tb.last_wins(articles(spark, sf_dir).withColumn("o", F.col("pos")), ["url"], "o").select("url", "pos", "source_name")


@query("""WITH e AS (SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') AS w FROM orders), b AS (SELECT DISTINCT l_orderkey AS event_id, l_partkey AS a FROM lineitem), g AS (SELECT id FROM e WHERE w = (SELECT max(w) FROM e))
SELECT 'events' AS tab, count(*) AS n FROM e WHERE id NOT IN (SELECT id FROM g) UNION ALL SELECT 'event_articles', count(*) FROM b WHERE event_id NOT IN (SELECT id FROM g)""")
def delete_week(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM").alias("week_label"))
    last = o.agg(F.max("week_label")).first()[0]
    bridge = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_partkey").alias("article_url")).distinct()
    empty = spark.createDataFrame([], "id string, week_label string"), spark.createDataFrame([], "report_id string, event_id string")
    left = tb.delete_week({"events": o, "event_articles": bridge, "reports": empty[0], "report_events": empty[1]}, last)
    return left["events"].agg(F.lit("events").alias("tab"), F.count(F.lit(1)).alias("n")).union(left["event_articles"].agg(F.lit("event_articles").alias("tab"), F.count(F.lit(1)).alias("n")))


@query("SELECT l_orderkey AS event_id, l_partkey AS article_url FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) WHERE l_partkey % 2 = 1")
def orphan_links(spark, sf_dir):
    _, bridge, arts, _ = _bridge(spark, sf_dir)
    return tb.orphans(bridge.select("event_id", "article_url").distinct(), arts.where("url % 2 = 0"), "article_url", "url")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 AND c_custkey % 3 <> 0 THEN 'db' WHEN c_custkey % 5 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS trust FROM customer")
def runtime_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    static = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"))
    runtime = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.lit("db").alias("name"), F.col("c_acctbal").alias("trust"))
    return registry.with_runtime(static, runtime)


@query(f"""WITH {ARTICLES_SQL} SELECT pos, url FROM articles WHERE pos % 5 <> 0 UNION ALL SELECT pos, url FROM articles WHERE pos % 5 = 0 AND url NOT IN (SELECT url FROM articles WHERE pos % 5 <> 0)""")
def two_stage_union(spark, sf_dir):
    a = articles(spark, sf_dir).select("pos", "url")
    return registry.two_stage_union(a.where("pos % 5 <> 0"), a.where("pos % 5 = 0"))


# ---- streaming: the table is read as a stream, run to its end, and the result returned as a table ----
def _drained(stream, mode="append"):
    """Every micro-batch is written below the shared folder under its number, so that a repeated one replaces itself."""
    path = f"{shared_folder(stream.sparkSession)}/stream-{uuid.uuid4().hex}"

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/out/{'all' if mode == 'complete' else f'batch={number}'}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out/*")


def _stream(spark, sf_dir, name):
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parq[u]et").withColumn("ts", F.col("ts").cast("timestamp"))  # a pattern: one file is no folder


@query("SELECT strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_week_counts(spark, sf_dir):
    counts = _drained(state.week_counts(_stream(spark, sf_dir, "events"), "ts", ["event_type"]), "complete")
    return counts.select(F.date_format("window.start", "yyyy-MM-dd").alias("week_start"), "event_type", "n")


@query("SELECT DISTINCT user_id FROM events")
def stream_first_sightings(spark, sf_dir):
    return _drained(state.first_sightings(_stream(spark, sf_dir, "events"), "user_id", "ts", "60 days")).select("user_id")


@query("""SELECT user_id, count(*) AS n, count(*) FILTER (s = 'changed') AS changed FROM (SELECT user_id, CASE WHEN lag(event_type) OVER w <> event_type THEN 'changed' ELSE 'same' END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)) GROUP BY 1""")
def stream_changes(spark, sf_dir):
    seen = _drained(state.changes(_stream(spark, sf_dir, "events"), F.col("user_id").cast("string"), F.col("event_type"), "ts", None))
    return seen.groupBy(F.col("key").cast("long").alias("user_id")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "changed").alias("changed"))
