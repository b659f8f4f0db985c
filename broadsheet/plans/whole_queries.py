"""Queries over whole tables and whole texts, and of operators that other queries leave out."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import texts, times, urls
from ..operators import curation, dedup, registry
from ..operators import events as ev
from ..operators import funnel as fn
from ..sources import readers
from ..sources import tables as tb
from .catalog import ORACLE_SQL, query
from .event_queries import _METRICS, _grouped, _metrics
from .scalar_queries import funnel_score
from .views import ARTICLES_SQL, activity, articles, as_of, table, with_event

#: The articles view with the whole text as summary, as articles() has it.
_WHOLE = ARTICLES_SQL.replace("left(d.text, 2000) AS summary", "d.text AS summary")


# ---- registries and tables that every row goes into ------------------------------------------------
@query(f"""WITH {_WHOLE}, old AS (SELECT DISTINCT url, '0' AS h FROM articles WHERE pos % 4 = 0),
n AS (SELECT url, left(sha256(url || '||' || title || '||' || summary), 16) AS h FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS r FROM articles) WHERE r = 1)
SELECT n.url, CASE WHEN old.url IS NOT NULL THEN 'seen_again' ELSE 'new' END AS status, n.h AS content_hash, old.url IS NOT NULL AS changed FROM n LEFT JOIN old ON old.url = n.url""")
def url_registry_whole(spark, sf_dir):
    """A quarter of the URLs is known; the batch is the whole table."""
    a = articles(spark, sf_dir)
    old = a.where("pos % 4 = 0").select("url").distinct().select(
        "url", F.lit("s").alias("source_id"), as_of().alias("first_seen"), as_of().alias("last_seen"), F.lit("0").alias("content_hash"), F.lit("new").alias("status"), F.lit("2024-01-01").alias("date_bucket")
    )
    return dedup.registered(old, a, as_of()).select("url", "status", "content_hash", "changed")


def _customers(spark, sf_dir):
    """Customers whose id 3 does not divide are there; all others come, and the even ones come again."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("score"), F.col("c_mktsegment").alias("first_seen"))
    new = c.where("id % 3 = 0 OR id % 2 = 0").select("id", F.upper("name").alias("name"), F.when(F.col("id") % 4 == 0, F.col("score") + 1).alias("score"), F.lit("now").alias("first_seen"))
    return c, c.where("id % 3 <> 0"), new


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS name,
  CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS score, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment ELSE 'now' END AS first_seen,
  CASE WHEN c_custkey % 3 = 0 THEN 'inserted' WHEN c_custkey % 2 = 0 THEN 'updated' ELSE 'kept' END AS action FROM customer""")
def upsert_whole(spark, sf_dir):
    _, old, new = _customers(spark, sf_dir)
    return tb.upsert(old, new, ["id"], keep=("first_seen",), fill=("score",), action=True)


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE upper(c_name) END AS name FROM customer")
def insert_ignore_whole(spark, sf_dir):
    _, old, new = _customers(spark, sf_dir)
    return tb.insert_ignore(old, new, ["id"]).select("id", "name")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS name FROM customer")
def replace_rows_whole(spark, sf_dir):
    _, old, new = _customers(spark, sf_dir)
    return tb.replace_rows(old, new, ["id"]).select("id", "name")


@query("SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS score FROM customer")
def patch_rows_whole(spark, sf_dir):
    every, _, new = _customers(spark, sf_dir)
    return tb.patch(every, new, ["id"], ("score",)).select("id", "name", "score")


# ---- whole texts -----------------------------------------------------------------------------------
@query(f"""WITH {_WHOLE}
SELECT pos, left(sha256(url || '||' || title || '||' || summary), 16) AS content_hash, left(sha256(url), 16) AS article_id,
  'evt_' || left(sha256(strftime(published, '%G-W%V') || '|' || category || '|' || trim(title)), 12) AS event_key,
  md5(url || ':' || strftime(published, '%Y-%m-%d')) AS dedup_key, left(md5('GET:' || url), 16) AS request_key FROM articles""")
def content_hashes_whole(spark, sf_dir):
    a = articles(spark, sf_dir)
    return a.select(
        "pos", urls.content_hash(F.col("url"), F.col("title"), F.col("summary")).alias("content_hash"), urls.article_id(F.col("url")).alias("article_id"),
        urls.event_id(times.week_label(F.col("published")), F.col("category"), F.col("title")).alias("event_key"),
        urls.dedup_key(F.col("url"), times.day_bucket(F.col("published"))).alias("dedup_key"), urls.request_key(F.lit("GET"), F.col("url")).alias("request_key"),
    )


@query(f"""WITH {_WHOLE} SELECT pos FROM articles
WHERE floor(epoch(TIMESTAMP '2024-01-31 00:00:00' - published) / 86400) <= 20
  AND NOT regexp_matches(title || ' ' || summary, '(?i)(?:(?:^|[^\\p{{L}}\\p{{N}}_])zof(?:$|[^\\p{{L}}\\p{{N}}_])|ereaea)') AND regexp_matches(title || ' ' || summary, '(?i)(?:er+e|ou)')""")
def post_filter_whole(spark, sf_dir):
    return readers.post_filtered(articles(spark, sf_dir), as_of(), F.col("published"), 20, ["er+e", "ou"], ["zof", "ereaea"]).select("pos")


@query(f"""WITH {_WHOLE} SELECT pos, (CAST(contains(lower(summary), 'the') AS INTEGER) + CAST(contains(lower(summary), 'que') AS INTEGER) + CAST(contains(lower(summary), 'und') AS INTEGER)) >= 2 AS cross_domain FROM articles""")
def cross_domain_whole(spark, sf_dir):
    return articles(spark, sf_dir).select("pos", texts.cross_domain(F.col("summary"), ["The", "que", "und"]).alias("cross_domain"))


# ---- scores with every part ------------------------------------------------------------------------
@query(f"""WITH {_WHOLE}, q AS (SELECT event_id, published, CASE pos % 5 WHEN 0 THEN 'rss:OpenAI.com' WHEN 1 THEN 'web:arxiv.org' WHEN 2 THEN 'web:Reddit.com' WHEN 3 THEN NULL ELSE source_id END AS sid,
  CAST(CASE pos % 5 WHEN 0 THEN 0.95 WHEN 1 THEN 0.9 WHEN 2 THEN 0.2 WHEN 3 THEN NULL ELSE 0.35 END AS DOUBLE) AS quality,
  CASE WHEN length(summary) > 0 THEN least(CAST(length(summary) AS DOUBLE) / length(left(summary, 333)), 5.0) / 5 END AS ratio FROM grouped)
SELECT event_id, count(*) AS n, count(DISTINCT sid) AS sources, round(coalesce(max(quality), 0.35), 4) AS source_quality, round(coalesce(avg(ratio), 0), 4) AS article_quality,
  round(epoch(TIMESTAMP '2024-01-31 00:00:00' - min(published)) / 86400, 3) AS age_days FROM q GROUP BY event_id""")
def event_quality(spark, sf_dir):
    """Trust in sources by domain, whatever its case, and how much of the articles is text beyond the summary."""
    m = F.col("pos") % 5
    rows = _grouped(spark, sf_dir).withColumn("source_id", F.when(m == 0, "rss:OpenAI.com").when(m == 1, "web:arxiv.org").when(m == 2, "web:Reddit.com").when(m == 3, "").otherwise(F.col("source_id")))
    found = ev.objective_metrics(rows, ["event_id"], as_of(), F.col("published"), "source_id", F.col("summary"), F.left("summary", F.lit(333)))
    return found.select("event_id", "n", "sources", "source_quality", "article_quality", F.round("age_days", 3).alias("age_days"))


@query(f"""WITH {_METRICS}, d AS (SELECT *, CASE WHEN span_days >= 2 OR user_id % 10 >= 7 THEN 14.0 ELSE 3.0 END AS half_life, least(user_id % 10 / 4.0, 1) AS importance FROM o),
f AS (SELECT *, greatest(exp(-ln(2) * age / half_life), 0.01) AS decay FROM d)
SELECT user_id, event_type, CAST(half_life AS DOUBLE) AS half_life, round((importance * 0.3 + 0.125 + 0.075) * 0.6 + (coverage * 0.25 + source_diversity * 0.1 + recency * 0.05) * 0.4, 3) AS parts,
  round(((importance * 0.3 + 0.125 + 0.075) * 0.6 + (coverage * 0.25 + source_diversity * 0.1 + recency * 0.05) * 0.4) * least(n / 4.0, 1) * decay, 3) AS final_score FROM f""")
def scores_by_importance(spark, sf_dir):
    """Importance on a scale to 10 chooses the half-life, and clamped to 1 the model's part."""
    user, half = F.col("user_id") % 10, F.lit(0.5)
    metrics = _metrics(spark, sf_dir)
    long = ev.score_events(metrics, user.cast("double"), half, half).select("user_id", "event_type", "half_life")
    rows = metrics.join(long, ["user_id", "event_type"])
    llm = F.least(user / 4.0, F.lit(1.0)) * 0.3 + 0.125 + 0.075
    parts = llm * 0.6 + (F.col("coverage") * 0.25 + F.col("source_diversity") * 0.1 + F.col("recency") * 0.05) * 0.4
    decayed = F.greatest(F.exp(F.lit(-0.6931471805599453) * F.col("age_days") / F.col("half_life")), F.lit(0.01))
    return rows.select("user_id", "event_type", "half_life", F.round(parts, 3).alias("parts"), F.round(parts * F.least(F.col("n") / 4.0, F.lit(1.0)) * decayed, 3).alias("final_score"))


# ---- operators without another query ---------------------------------------------------------------
_LINK_HOST = "lower(regexp_extract(url, '^[A-Za-z]+://([^:/?#]*)', 1))"


@query(f"""WITH p AS (SELECT page_id, html, {_LINK_HOST} AS h, CASE page_id % 3 WHEN 0 THEN 'LLM' ELSE 'Agent' END AS category FROM pages),
l AS (SELECT page_id, category, regexp_replace(h, '^(www|blog|news|dev|docs)\\.', '') AS domain, 'https://' || h || x AS link FROM (SELECT *, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS x FROM p)),
k AS (SELECT * FROM l WHERE domain NOT IN (SELECT regexp_replace(h, '^(www|blog|news|dev|docs)\\.', '') FROM p WHERE page_id % 10 = 0)),
c AS (SELECT domain, category, count(DISTINCT page_id) AS n FROM k GROUP BY 1, 2)
SELECT domain, count(DISTINCT link) AS urls, count(DISTINCT page_id) AS refs, min(link) AS first_url, CAST(least(5 + count(DISTINCT link), 8) AS BIGINT) AS weight,
  (SELECT arg_min(c.category, -c.n * 10 + CASE c.category WHEN 'Agent' THEN 0 ELSE 1 END) FROM c WHERE c.domain = k.domain) AS category FROM k GROUP BY domain""")
def link_categories(spark, sf_dir):
    """Mined domains that are not known, with the category that most of their pages have."""
    pages = table(spark, sf_dir, "pages").withColumn("category", F.when(F.col("page_id") % 3 == 0, "LLM").otherwise("Agent"))
    host = urls.host(F.col("url"))
    links = F.transform(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)), lambda h: F.concat(F.lit("https://"), host, h))
    known = pages.where("page_id % 10 = 0").select(urls.service_domain(F.col("url")).alias("domain")).distinct()
    return registry.mined_links(pages, known, "page_id", links, "category")


@query(f"""WITH {_WHOLE}, e AS (SELECT DISTINCT event_id FROM grouped), i AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM e),
b AS (SELECT event_id, i // 2 AS batch_id, CAST(i % 2 AS INTEGER) AS event_index, i // 2 % 3 <> 0 AND i % 2 = 0 AS answered FROM i)
SELECT event_id, batch_id, event_index, CAST(CASE WHEN answered THEN least(batch_id % 7 / 4.0, 1) ELSE 0.5 END AS DOUBLE) AS importance, CAST(0.5 AS DOUBLE) AS novelty, CAST(CASE WHEN answered THEN 0 ELSE 0.5 END AS DOUBLE) AS impact
FROM b WHERE NOT answered OR batch_id % 5 <> 0""")
def curated_events(spark, sf_dir):
    """Events in batches of two, with what a model's replies say of them; some batches stay without a reply."""
    events = curation.batches(_grouped(spark, sf_dir).select("event_id").distinct(), "event_id", 2)
    b = F.col("batch_id")
    said = F.to_json(F.array(F.struct(F.lit(0).alias("event_index"), (b % 5 != 0).alias("is_relevant"), (b % 7 / 4.0).alias("importance"), F.lit(-0.5).alias("impact"))))
    answered = events.where((F.col("event_index") == 0) & (b % 3 != 0)).select("batch_id", F.concat(F.lit("```json\n"), said, F.lit("\n```")).alias("reply"))
    replies = curation.replies(answered).select("batch_id", "event_index", "is_relevant", "importance", "novelty", "impact")
    return ev.curated(events, replies).select("event_id", "batch_id", "event_index", "importance", "novelty", "impact")


@query(f"""WITH {_WHOLE}, {{built}} SELECT event_id, CASE category WHEN 'LLM' THEN 'Language models' ELSE category END AS curated_category, TRUE AS is_relevant, CAST(0.5 AS DOUBLE) AS novelty, CAST(0.5 AS DOUBLE) AS impact, CAST(0.5 AS DOUBLE) AS curated_importance
FROM g""".format(built="g AS (SELECT event_id, min(category) AS category FROM grouped GROUP BY event_id)"))
def fallback_events(spark, sf_dir):
    """What events get without a model."""
    built = ev.build_events(with_event(articles(spark, sf_dir)), "event_id")
    return ev.fallback_curation(built, {"LLM": "Language models"}).select("event_id", "curated_category", "is_relevant", "novelty", "impact", "curated_importance")


@query(f"SELECT page_id, CAST(least(10, greatest(1, score // 10)) AS INTEGER) AS weight, CAST(0.5 AS DOUBLE) AS trust, score AS eval_score FROM ({ORACLE_SQL['funnel_score']}) WHERE score >= 40")
def passed_sources(spark, sf_dir):
    decided = funnel_score(spark, sf_dir).withColumn("decision", F.when(F.col("score") >= 40, fn.PASS).otherwise(fn.REVIEW))
    return fn.as_sources(decided).select("page_id", "weight", "trust", "eval_score")


@query("""WITH s AS (SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 0 THEN 'exa_search' WHEN 1 THEN NULL ELSE 'rss' END AS connector, CASE c_custkey % 5 WHEN 0 THEN FALSE WHEN 1 THEN NULL ELSE TRUE END AS active FROM customer)
SELECT id, CASE WHEN connector = 'exa_search' THEN 'search' ELSE 'stable' END AS stage FROM s WHERE coalesce(active, TRUE)""")
def connector_stages(spark, sf_dir):
    key = F.col("c_custkey")
    connector = F.when(key % 4 == 0, "exa_search").when(key % 4 != 1, "rss")
    active = F.when(key % 5 == 0, False).when(key % 5 != 1, True)
    stable, search = registry.split_connectors(table(spark, sf_dir, "customer").select(key.alias("id"), connector.alias("connector"), active.alias("active")))
    return stable.select("id", F.lit("stable").alias("stage")).unionByName(search.select("id", F.lit("search").alias("stage")))


@query("""SELECT doc_id AS page_id, CAST(o AS INTEGER) AS ordinal, source AS owner, lang || o AS repo FROM documents, range(10) t(o) WHERE o < doc_id % 13""")
def trending_repositories(spark, sf_dir):
    """Pages that list up to twelve repositories, of which ten count."""
    d = table(spark, sf_dir, "documents")
    row = lambda i: F.concat(F.lit('<article class="Box-row"><h2 class="h3">\n <a data-x="1" href="/'), "source", F.lit("/"), "lang", i.cast("string"), F.lit('">a</a></h2></article>'))
    listed = F.when(F.col("doc_id") % 13 > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("doc_id") % 13 - 1), row)).otherwise(F.array().cast("array<string>"))
    pages = d.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("<main>"), F.array_join(listed, ""), F.lit("</main>")).alias("html"))
    return readers.trending(pages)


@query("SELECT event_id, event_type, value FROM events WHERE event_type <> (SELECT min(event_type) FROM events) OR value > 0.5")
def cached_replies(spark, sf_dir):
    """Rows whose reply a cache has, and rows that are still to be asked; here those with a low value of one type are left out of both."""
    rows = activity(spark, sf_dir).select("event_id", "event_type", "value", F.col("event_type").alias("title"), F.col("event_id").cast("string").alias("summary"))
    first = F.broadcast(rows.agg(F.min("event_type").alias("least")))
    asked = rows.join(first, (F.col("event_type") == F.col("least")) & (F.col("value") <= 0.5), "left_anti")
    prompt = F.lit("v1")
    cache = asked.where("event_id % 2 = 0").select(F.sha2(F.concat(prompt, "title", "summary"), 256).alias("cache_key"))
    there, missing = curation.cached(asked, cache, prompt)
    return there.unionByName(missing).select("event_id", "event_type", "value")
