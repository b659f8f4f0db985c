"""Operators on parts of the tables and on cut summaries, against the SQL that says the same of those parts.

The registered queries run over whole tables and texts (plans/whole_queries.py); these smaller inputs have rows that only one side has.
"""

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import texts, times, urls
from broadsheet.operators import dedup
from broadsheet.plans import views
from broadsheet.plans.views import ARTICLES_SQL, as_of, table
from broadsheet.sources import readers
from broadsheet.sources import tables as tb
from tests.oracle import same

CASES = {}


def query(sql):
    return lambda function: CASES.setdefault(function.__name__, (function, sql))


def articles(spark, sf_dir):
    return views.articles(spark, sf_dir).withColumn("summary", F.left("summary", F.lit(2000)))


@query(f"""WITH {ARTICLES_SQL}, old AS (SELECT DISTINCT url, '0' AS h FROM articles WHERE pos % 4 = 0),
n AS (SELECT url, left(sha256(url || '||' || title || '||' || summary), 16) AS h FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS r FROM articles WHERE pos % 2 = 0) WHERE r = 1)
SELECT coalesce(old.url, n.url) AS url, CASE WHEN old.url IS NOT NULL AND n.url IS NOT NULL THEN 'seen_again' ELSE 'new' END AS status, coalesce(n.h, old.h) AS content_hash, old.url IS NOT NULL AND n.url IS NOT NULL AS changed FROM old FULL JOIN n ON old.url = n.url""")
def url_registry(spark, sf_dir):
    a = articles(spark, sf_dir)
    old = a.where("pos % 4 = 0").select("url").distinct().select(
        "url", F.lit("s").alias("source_id"), as_of().alias("first_seen"), as_of().alias("last_seen"), F.lit("0").alias("content_hash"), F.lit("new").alias("status"), F.lit("2024-01-01").alias("date_bucket")
    )
    return dedup.registered(old, a.where("pos % 2 = 0"), as_of()).select("url", "status", "content_hash", "changed")


def _customers(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("score"), F.col("c_mktsegment").alias("first_seen"))
    old = c.where("id % 3 <> 0")
    new = c.where("id % 2 = 0").select("id", F.upper("name").alias("name"), F.when(F.col("id") % 4 == 0, F.col("score") + 1).alias("score"), F.lit("now").alias("first_seen"))
    return old, new


@query("""WITH o AS (SELECT * FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey, upper(c_name) AS c_name, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 END AS c_acctbal FROM customer WHERE c_custkey % 2 = 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS id, coalesce(n.c_name, o.c_name) AS name, coalesce(n.c_acctbal, o.c_acctbal) AS score, CASE WHEN o.c_custkey IS NOT NULL THEN o.c_mktsegment ELSE 'now' END AS first_seen,
  CASE WHEN n.c_custkey IS NULL THEN 'kept' WHEN o.c_custkey IS NULL THEN 'inserted' ELSE 'updated' END AS action FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""")
def upsert_rows(spark, sf_dir):
    old, new = _customers(spark, sf_dir)
    return tb.upsert(old, new, ["id"], keep=("first_seen",), fill=("score",), action=True)


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE upper(c_name) END AS name FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0")
def insert_ignore(spark, sf_dir):
    old, new = _customers(spark, sf_dir)
    return tb.insert_ignore(old, new, ["id"]).select("id", "name")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS name FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0")
def replace_rows(spark, sf_dir):
    old, new = _customers(spark, sf_dir)
    return tb.replace_rows(old, new, ["id"]).select("id", "name")


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS score FROM customer WHERE c_custkey % 3 <> 0")
def patch_rows(spark, sf_dir):
    old, new = _customers(spark, sf_dir)
    return tb.patch(old, new, ["id"], ("score",)).select("id", "name", "score")


@query(f"""WITH {ARTICLES_SQL}
SELECT pos, left(sha256(url || '||' || title || '||' || summary), 16) AS content_hash, left(sha256(url), 16) AS article_id,
  'evt_' || left(sha256(strftime(published, '%G-W%V') || '|' || category || '|' || trim(title)), 12) AS event_key,
  md5(url || ':' || strftime(published, '%Y-%m-%d')) AS dedup_key, left(md5('GET:' || url), 16) AS request_key FROM articles""")
def content_hashes(spark, sf_dir):
    a = articles(spark, sf_dir)
    return a.select(
        "pos", urls.content_hash(F.col("url"), F.col("title"), F.col("summary")).alias("content_hash"), urls.article_id(F.col("url")).alias("article_id"),
        urls.event_id(times.week_label(F.col("published")), F.col("category"), F.col("title")).alias("event_key"),
        urls.dedup_key(F.col("url"), times.day_bucket(F.col("published"))).alias("dedup_key"), urls.request_key(F.lit("GET"), F.col("url")).alias("request_key"),
    )


@query(f"""WITH {ARTICLES_SQL} SELECT pos FROM articles
WHERE floor(epoch(TIMESTAMP '2024-01-31 00:00:00' - published) / 86400) <= 20
  AND NOT regexp_matches(title || ' ' || summary, '(?i)(?:(?:^|[^\\p{{L}}\\p{{N}}_])of(?:$|[^\\p{{L}}\\p{{N}}_])|tionnt)') AND regexp_matches(title || ' ' || summary, '(?i)(?:er+e|ou)')""")
def post_filter(spark, sf_dir):
    return readers.post_filtered(articles(spark, sf_dir), as_of(), F.col("published"), 20, ["er+e", "ou"], ["of", "tionnt"]).select("pos")


@query(f"""WITH {ARTICLES_SQL} SELECT pos, (CAST(contains(lower(summary), 'the') AS INTEGER) + CAST(contains(lower(summary), 'que') AS INTEGER) + CAST(contains(lower(summary), 'und') AS INTEGER)) >= 2 AS cross_domain FROM articles""")
def cross_domain_flag(spark, sf_dir):
    return articles(spark, sf_dir).select("pos", texts.cross_domain(F.col("summary"), ["The", "que", "und"]).alias("cross_domain"))


@pytest.mark.parametrize("name", sorted(CASES))
def test_narrow_input_equals_its_sql(spark, name):
    same(spark, *CASES[name])
