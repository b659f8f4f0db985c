"""Queries of deduplication, aggregation, scoring, ranking, similarity and clustering."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scores, times
from ..operators import clustering, curation, dedup, metrics, registry
from ..operators import events as ev
from .catalog import query
from .views import ARTICLES_SQL, activity, articles, as_of, table, with_event


def _grouped(spark, sf_dir):
    return with_event(articles(spark, sf_dir))


@query(f"WITH {ARTICLES_SQL} SELECT pos, url FROM (SELECT pos, url, row_number() OVER (PARTITION BY url ORDER BY pos) AS r FROM articles) WHERE r = 1")
def hard_dedup_first_wins(spark, sf_dir):
    return dedup.hard_dedup(articles(spark, sf_dir).select("pos", "url"))


@query(f"""WITH {ARTICLES_SQL}, r AS (SELECT DISTINCT url FROM articles WHERE pos % 10 = 0), b AS (SELECT pos, url, row_number() OVER (PARTITION BY url ORDER BY pos) AS n FROM articles WHERE pos % 10 <> 0)
SELECT pos, url FROM b WHERE n = 1 AND url NOT IN (SELECT url FROM r)""")
def dedup_against_registry(spark, sf_dir):
    a = articles(spark, sf_dir).select("pos", "url")
    return dedup.hard_dedup(a.where("pos % 10 <> 0"), a.where("pos % 10 = 0").select("url").distinct())


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS r FROM events) WHERE r = 1")
def day_dedup(spark, sf_dir):
    e = activity(spark, sf_dir)
    return dedup.day_dedup(e, F.concat_ws("/", "user_id", "event_type"), F.col("ts"), "event_id").select("event_id")


@query("""SELECT event_id, lag(event_type) OVER w AS previous_hash, CASE WHEN row_number() OVER w = 1 THEN 'new' WHEN lag(event_type) OVER w <> event_type THEN 'changed' ELSE 'seen_again' END AS status
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_type)""")
def change_detection(spark, sf_dir):
    return dedup.change_detection(activity(spark, sf_dir), "user_id", "ts", "event_type").select("event_id", "previous_hash", "status")


@query("SELECT user_id, max(ts) AS last_ts FROM events GROUP BY user_id HAVING max(ts) >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 2 DAY")
def expire_old(spark, sf_dir):
    seen = activity(spark, sf_dir).groupBy("user_id").agg(F.max("ts").alias("last_seen"))
    return dedup.expired(seen, as_of(), 2).select("user_id", F.col("last_seen").cast("timestamp_ntz").alias("last_ts"))


@query(f"WITH {ARTICLES_SQL} SELECT category, count(*) AS n FROM articles GROUP BY category")
def category_counts(spark, sf_dir):
    return articles(spark, sf_dir).groupBy(ev.category_of(F.col("category")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {ARTICLES_SQL} SELECT source_name, count(*) AS n, count(DISTINCT category) AS categories, count(*) FILTER (priority_score = 8) AS good FROM articles GROUP BY source_name")
def source_counts(spark, sf_dir):
    return articles(spark, sf_dir).groupBy("source_name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("category").alias("categories"), F.count_if(F.col("priority_score") == 8).alias("good"))


@query(f"""WITH {ARTICLES_SQL}, c AS (SELECT source_name, category, count(*) AS n, min(pos) AS f FROM articles GROUP BY 1, 2)
SELECT source_name, category, n FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY n DESC, f) AS r FROM c) WHERE r = 1""")
def category_mode(spark, sf_dir):
    return ev.category_mode(articles(spark, sf_dir), "source_name")


@query(f"WITH {ARTICLES_SQL} SELECT source_name, pos, title FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY priority_score DESC, pos) AS r FROM articles) WHERE r = 1")
def representatives(spark, sf_dir):
    return ev.representatives(articles(spark, sf_dir), "source_name")


_BUILT = """g AS (SELECT event_id, count(*) AS n_articles, avg(priority_score) AS m, string_agg(DISTINCT source_name, ', ' ORDER BY source_name) AS source_names, count(DISTINCT source_name) AS source_count, min(category) AS category FROM grouped GROUP BY event_id),
l AS (SELECT event_id, title FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY priority_score DESC, pos) AS r FROM grouped) WHERE r = 1)"""


@query(f"""WITH {ARTICLES_SQL}, {_BUILT}
SELECT event_id, title, category, n_articles, round(m, 6) AS mean_priority, round(least(m / 10 * 0.6 + least(n_articles / 3.0, 1) * 0.4, 1), 3) AS importance, source_names, source_count FROM g JOIN l USING (event_id)""")
def event_build(spark, sf_dir):
    return ev.build_events(_grouped(spark, sf_dir), "event_id").withColumn("mean_priority", F.round("mean_priority", 6)).drop("article_pos")


_METRICS = """m AS (SELECT user_id, event_type, count(*) AS n, count(DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT)) AS sources, max(ts) AS latest, min(ts) AS earliest FROM events GROUP BY 1, 2),
o AS (SELECT user_id, event_type, n, sources, round(least(n / 5.0, 1), 4) AS coverage, round(1 / (1 + exp(ln(2) / 48 * (epoch(TIMESTAMP '2024-01-31 00:00:00' - latest) / 3600))), 4) AS recency,
  round(sources / n, 4) AS source_diversity, round(epoch(latest - earliest) / 86400, 2) AS span_days, epoch(TIMESTAMP '2024-01-31 00:00:00' - earliest) / 86400 AS age FROM m)"""
_SCORED = f"""{_METRICS}, d AS (SELECT *, CASE WHEN span_days >= 2 THEN 14.0 ELSE 3.0 END AS half_life FROM o),
f AS (SELECT *, greatest(exp(-ln(2) * age / half_life), 0.01) AS decay FROM d),
s AS (SELECT *, round((0.35 * 0.6 + (coverage * 0.25 + source_diversity * 0.1 + recency * 0.05) * 0.4) * least(n / 4.0, 1) * decay, 4) AS final_score FROM f)"""


def _metrics(spark, sf_dir):
    e = activity(spark, sf_dir).withColumn("source_id", F.get_json_object("props", "$.k"))
    return ev.objective_metrics(e, ["user_id", "event_type"], as_of(), F.col("ts"))


@query(f"WITH {_METRICS} SELECT user_id, event_type, n, sources, coverage, recency, source_diversity, span_days FROM o")
def objective_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir).select("user_id", "event_type", "n", "sources", "coverage", "recency", "source_diversity", "span_days")


def _scored(spark, sf_dir):
    half = F.lit(0.5)
    return ev.score_events(_metrics(spark, sf_dir), half, half, half)


@query(f"WITH {_SCORED} SELECT user_id, event_type, CAST(half_life AS DOUBLE) AS half_life, round(decay, 4) AS time_decay, final_score FROM s")
def final_scores(spark, sf_dir):
    return _scored(spark, sf_dir).select("user_id", "event_type", "half_life", "time_decay", "final_score")


@query(f"""WITH {_SCORED} SELECT event_type, user_id, final_score, CAST(rank AS INTEGER) AS rank FROM (
SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY final_score DESC, source_diversity DESC, recency DESC, user_id) AS rank FROM s) WHERE rank <= 50""")
def top_n_per_category(spark, sf_dir):
    order = [F.desc("final_score"), F.desc("source_diversity"), F.desc("recency"), F.asc("user_id")]
    return ev.top_n(_scored(spark, sf_dir), "event_type", order).select("event_type", "user_id", "final_score", "rank")


@query(f"WITH {ARTICLES_SQL}, {_BUILT} SELECT event_id, round(round(least(m / 10 * 0.6 + least(n_articles / 3.0, 1) * 0.4, 1), 3) * 0.4 + 0.3, 6) AS weight FROM g ORDER BY weight DESC, event_id LIMIT 100")
def weighted_order(spark, sf_dir):
    built = ev.build_events(_grouped(spark, sf_dir), "event_id")
    return built.select("event_id", F.round(scores.weighted(F.col("importance"), F.lit(0.5), F.lit(0.5)), 6).alias("weight")).orderBy(F.desc("weight"), "event_id").limit(100)


_WEEKS = """e AS (SELECT event_id, strftime(ts, '%G-W%V') AS week_label, event_type AS category FROM events WHERE NOT (strftime(ts, '%G-W%V') = '2024-W05' AND event_type IN (SELECT min(event_type) FROM events))),
w AS (SELECT week_label, dense_rank() OVER (ORDER BY week_label DESC) - 1 AS o FROM (SELECT DISTINCT week_label FROM e WHERE week_label <= '2024-W05')),
k AS (SELECT e.*, w.o FROM e JOIN w USING (week_label) WHERE w.o <= 4), n AS (SELECT category, min(o) AS o FROM k GROUP BY category)"""


@query(f"WITH {_WEEKS} SELECT event_id, category, o > 0 AS carried_over FROM k JOIN n USING (category, o) WHERE EXISTS (SELECT 1 FROM w WHERE o = 0 AND week_label = '2024-W05')")
def carry_over(spark, sf_dir):
    e = activity(spark, sf_dir).select("event_id", times.week_label(F.col("ts")).alias("week_label"), F.col("event_type").alias("category"))
    first = e.agg(F.min("category").alias("least"))
    rows = e.join(F.broadcast(first), (F.col("category") == F.col("least")) & (F.col("week_label") == "2024-W05"), "left_anti")
    return ev.carry_over(rows, "2024-W05").select("event_id", "category", "carried_over")


@query(f"""WITH {ARTICLES_SQL} SELECT event_id, n, sources, CASE WHEN h < 1 THEN 0 ELSE h END AS hours FROM (
SELECT event_id, count(*) AS n, count(DISTINCT source_id) AS sources, epoch(max(published) - min(published)) / 3600 AS h FROM grouped GROUP BY event_id)""")
def stats_lines(spark, sf_dir):
    return ev.stats_line(_grouped(spark, sf_dir), "event_id", F.col("published"))


@query(f"""WITH {ARTICLES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY pos) - 1 AS i FROM grouped)
SELECT event_id, string_agg('[' || i || '] ' || title || ' (from ' || source_name || ')' || chr(10) || left(summary, 400), chr(10) ORDER BY i) AS block FROM r WHERE i < 20 GROUP BY event_id""")
def prompt_blocks(spark, sf_dir):
    return ev.prompt_blocks(_grouped(spark, sf_dir), "event_id")


@query(f"""WITH {ARTICLES_SQL}, g AS (SELECT event_id, list(pos ORDER BY pos) AS ps FROM grouped GROUP BY event_id), x AS (SELECT event_id, unnest(list_concat(ps, [-1])) AS pos, unnest(range(len(ps) + 1)) AS ordinal FROM g)
SELECT x.event_id, CAST(x.ordinal AS INTEGER) AS ordinal, a.pos, a.source_name FROM x JOIN articles a ON a.pos = x.pos""")
def gather_positions(spark, sf_dir):
    events = ev.build_events(_grouped(spark, sf_dir), "event_id").withColumn("article_pos", F.concat("article_pos", F.array(F.lit(-1).cast("long"))))
    return ev.gather(events, articles(spark, sf_dir)).select("event_id", "ordinal", "pos", "source_name")


@query(f"WITH {ARTICLES_SQL}, {_BUILT} SELECT category, count(*) AS events, CAST(sum(n_articles) AS BIGINT) AS articles, bool_or(n_articles = 1) AS has_carried FROM g GROUP BY category")
def report_totals(spark, sf_dir):
    built = ev.build_events(_grouped(spark, sf_dir), "event_id").withColumn("carried_over", F.col("n_articles") == 1)
    return ev.report_totals(built)


@query(f"""WITH {ARTICLES_SQL}, c(name, ord) AS (VALUES ('LLM news', 1), ('Sim', 2), ('Agent', 3))
SELECT pos, coalesce((SELECT arg_min(name, ord) FROM c WHERE contains(category, name) OR contains(name, category)), 'LLM') AS report_category FROM articles""")
def fuzzy_category(spark, sf_dir):
    names = spark.createDataFrame([("LLM news", 1), ("Sim", 2), ("Agent", 3)], "name string, ord int")
    return ev.fuzzy_category(articles(spark, sf_dir), names).select("pos", "report_category")


@query("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.v, b.v), 5) AS similarity FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) > 0.35""")
def similarity_pairs(spark, sf_dir):
    return dedup.similar_pairs(table(spark, sf_dir, "embeddings"), 0.35).withColumn("similarity", F.round("similarity", 5))


@query("""WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
p AS (SELECT b.vec_id AS b, list(a.vec_id) AS before FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) > 0.35 GROUP BY b.vec_id),
o AS (SELECT e.vec_id, coalesce(p.before, []) AS before, row_number() OVER (ORDER BY e.vec_id) AS i FROM e LEFT JOIN p ON p.b = e.vec_id),
k AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL SELECT o.i, CASE WHEN list_has_any(k.kept, o.before) THEN k.kept ELSE list_append(k.kept, o.vec_id) END FROM k JOIN o ON o.i = k.i + 1)
SELECT unnest(kept) AS vec_id FROM (SELECT kept FROM k ORDER BY i DESC LIMIT 1)""")
def semantic_dedup_greedy(spark, sf_dir):
    return dedup.semantic_dedup(table(spark, sf_dir, "embeddings"), 0.35).select("vec_id")


@query("""WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS d FROM embeddings),
m AS (SELECT label, d, avg(v) AS m FROM x GROUP BY 1, 2), n AS (SELECT label, sqrt(sum(m * m)) AS len FROM m GROUP BY 1),
q AS (SELECT x.label, x.vec_id, sum((x.v - m.m / n.len) * (x.v - m.m / n.len)) AS d2 FROM x JOIN m ON m.label = x.label AND m.d = x.d JOIN n ON n.label = x.label GROUP BY 1, 2)
SELECT label, vec_id, CAST(rank AS INTEGER) AS rank, round(d2, 5) AS dist2 FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY d2, vec_id) AS rank FROM q) WHERE rank <= 3""")
def centroid_topk(spark, sf_dir):
    near = ev.centroid_nearest(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 3, 64)
    return near.withColumn("dist2", F.round("dist2", 5))


@query()
def online_linkage(spark, sf_dir):
    return clustering.online_linkage(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 0.2)


@query()
def density_clusters(spark, sf_dir):
    return clustering.density_clusters(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", 2, 0.65)


@query()
def clustered_articles(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("pos"), "embedding", F.when(F.col("label") < 5, F.lit("arXiv")).otherwise(F.lit("web")).alias("source_name"))
    return clustering.clustered(rows, dedup_at=0.5, link_at=0.2).select("pos", "bucket", "cluster")


_QUALITY = """t AS (SELECT CASE WHEN label < 7 THEN label END AS truth, (vec_id % 3 + label // 2 * 3) AS cluster FROM embeddings),
b AS (SELECT truth, cluster, count(*) AS tp FROM t WHERE truth IS NOT NULL GROUP BY 1, 2), c AS (SELECT cluster, count(*) AS cluster_size FROM t GROUP BY 1), g AS (SELECT truth, count(*) AS gt_size FROM t WHERE truth IS NOT NULL GROUP BY 1),
x AS (SELECT truth, gt_size, cluster_size, tp, cluster_size - tp AS fp, gt_size - tp AS fn FROM (SELECT *, row_number() OVER (PARTITION BY truth ORDER BY tp DESC, cluster) AS r FROM b) JOIN c USING (cluster) JOIN g USING (truth) WHERE r = 1)"""


def _labelled(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.when(F.col("label") < 7, F.col("label")).alias("truth"), (F.col("vec_id") % 3 + F.floor(F.col("label") / 2) * 3).alias("cluster"))


@query(f"WITH {_QUALITY} SELECT truth, gt_size, cluster_size, tp, fp, fn, round(tp / cluster_size, 4) AS prec, round(tp / gt_size, 4) AS rec, round(2 * (tp / cluster_size) * (tp / gt_size) / (tp / cluster_size + tp / gt_size), 4) AS f1 FROM x")
def cluster_quality(spark, sf_dir):
    return clustering.quality(_labelled(spark, sf_dir))


@query(f"""WITH {_QUALITY}, s AS (SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn FROM x)
SELECT tp, fp, fn, round(tp / (tp + fp), 4) AS prec, round(tp / (tp + fn), 4) AS rec, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 4) AS f1 FROM s""")
def cluster_quality_overall(spark, sf_dir):
    return clustering.overall(clustering.quality(_labelled(spark, sf_dir)))


@query("""WITH b AS (SELECT event_type AS name, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' AND event_type <> (SELECT max(event_type) FROM events) GROUP BY 1), c AS (SELECT event_type AS name, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND event_type <> (SELECT min(event_type) FROM events) GROUP BY 1)
SELECT coalesce(b.name, c.name) AS name, coalesce(b.n, 0) AS baseline, coalesce(c.n, 0) AS current, coalesce(c.n, 0) - coalesce(b.n, 0) AS delta FROM b FULL JOIN c ON b.name = c.name""")
def stage_metrics_diff(spark, sf_dir):
    e = activity(spark, sf_dir)
    ends = F.broadcast(e.agg(F.min("event_type").alias("lo"), F.max("event_type").alias("hi")))
    early, late = e.where("ts < timestamp'2024-01-15'"), e.where("ts >= timestamp'2024-01-15'")
    b = early.join(ends, F.col("event_type") == F.col("hi"), "left_anti").groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    c = late.join(ends, F.col("event_type") == F.col("lo"), "left_anti").groupBy(F.col("event_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return metrics.compared(b, c, "name", "n")


@query("""WITH s AS (SELECT user_id % 7 AS ord, count(*) AS n_in, count(*) FILTER (value > 0.5) AS n_out, count(*) * 0.5 AS elapsed_s FROM events GROUP BY 1)
SELECT CAST(sum(elapsed_s) AS DOUBLE) AS total_elapsed_s, arg_max(n_out, ord) AS final_count, count(*) AS stages FROM s""")
def run_summary(spark, sf_dir):
    stages = activity(spark, sf_dir).groupBy((F.col("user_id") % 7).alias("ord")).agg(F.count(F.lit(1)).alias("n_in"), F.count_if(F.col("value") > 0.5).alias("n_out"), (F.count(F.lit(1)) * F.lit(0.5)).alias("elapsed_s"))
    return metrics.run_summary(metrics.stage_rollup(stages))


@query(f"WITH {ARTICLES_SQL} SELECT row_number() OVER (ORDER BY pos) AS id, url, source_name AS source, priority_score AS score, CAST(NULL AS BOOLEAN) AS valid FROM articles")
def annotation_template(spark, sf_dir):
    return metrics.annotation_template(articles(spark, sf_dir)).select("id", "url", "source", "score", "valid")


@query(f"""WITH {ARTICLES_SQL}, r AS (SELECT pos, source_name, md5('42:' || pos) AS k, row_number() OVER (PARTITION BY source_name ORDER BY md5('42:' || pos)) AS r, count(*) OVER (PARTITION BY source_name) AS n, count(*) OVER () AS t FROM articles)
SELECT pos, source_name FROM r WHERE r <= greatest(1, CAST(round_even(70.0 * n / t, 0) AS INTEGER)) ORDER BY r, k LIMIT 70""")
def stratified_sample(spark, sf_dir):
    a = articles(spark, sf_dir).select("pos", "source_name")
    return registry.stratified_sample(a, "source_name", F.md5(F.concat(F.lit("42:"), F.col("pos").cast("string"))), 70)


@query("""WITH c AS (SELECT user_id, count(*) AS n FROM events WHERE value > 0.9 AND user_id % 10 <> 3 GROUP BY 1), s AS (SELECT DISTINCT user_id AS id, user_id % 7 + 3 AS sc, user_id % 4 AS st, CASE WHEN user_id % 5 = 0 THEN 'github' ELSE 'rss' END AS k FROM events), j AS (SELECT s.*, coalesce(c.n, 0) AS n FROM s LEFT JOIN c ON c.user_id = s.id)
SELECT id, n, CASE WHEN k = 'github' THEN sc WHEN n >= 2 THEN least(sc + 1, 10) WHEN n = 0 THEN sc - 2 ELSE sc - 1 END AS new_score, CASE WHEN k = 'github' THEN st WHEN n >= 2 THEN 0 WHEN n = 0 THEN st + 1 ELSE 0 END AS new_streak,
  k = 'github' OR CASE WHEN n = 0 THEN st + 1 ELSE 0 END < 4 AS new_active FROM j""")
def source_evaluation(spark, sf_dir):
    e = activity(spark, sf_dir)
    u = F.col("user_id")
    counts = e.where((F.col("value") > 0.9) & (u % 10 != 3)).groupBy(u.alias("id")).agg(F.count(F.lit(1)).alias("n"))
    sources = e.select("user_id").distinct().select(u.alias("id"), (u % 7 + 3).alias("eval_score"), (u % 4).alias("streak"), F.when(u % 5 == 0, "github").otherwise("rss").alias("connector"), F.lit(True).alias("active"))
    return registry.evaluate(sources, counts, 2, 4, ("github",), "id").select("id", "n", "new_score", "new_streak", "new_active")


@query("""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'click') AS n FROM events GROUP BY 1, 2), g AS (SELECT *, sum(CASE WHEN n > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY day) AS i FROM d)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, sum(CASE WHEN n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, i ORDER BY day)::BIGINT AS streak FROM g""")
def zero_streaks(spark, sf_dir):
    days = activity(spark, sf_dir).groupBy("user_id", times.day_bucket(F.col("ts")).alias("day")).agg(F.count_if(F.col("event_type") == "click").alias("n"))
    return registry.streaks(days, "user_id", "day").select("user_id", "day", "streak")


@query("SELECT s_suppkey AS key, s_suppkey % 2 = 1 AS added FROM (SELECT s_suppkey, row_number() OVER (PARTITION BY s_suppkey % 2 ORDER BY s_acctbal DESC, s_suppkey) AS r, (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0) AS have FROM supplier) WHERE s_suppkey % 2 = 0 OR r <= greatest(0, 80 - have)")
def merge_capped(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), "s_acctbal")
    return registry.merge_capped(s.where("key % 2 = 0"), s.where("key % 2 = 1"), "key", 80, [F.desc("s_acctbal"), F.asc("key")]).select("key", "added")


@query("""SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch(ts)::BIGINT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) AS in_window, count(*) OVER (PARTITION BY user_id ORDER BY epoch(ts)::BIGINT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) > 2 AS over
FROM (SELECT *, to_timestamp(floor(epoch(ts))) AS _t FROM events)""".replace("epoch(ts)::BIGINT", "floor(epoch(ts))"))
def request_rate(spark, sf_dir):
    return registry.rate(activity(spark, sf_dir), "user_id", "ts", 3600, 2).select("event_id", "in_window", "over")


@query("SELECT regexp_replace(lower(regexp_extract(url, '^[A-Za-z]+://([^:/?#]*)', 1)), '^[w.]+', '') AS domain, count(*) FILTER (page_id % 3 = 0) AS failures, count(*) FILTER (page_id % 3 = 0) >= 3 AS dead FROM pages GROUP BY 1")
def domain_health(spark, sf_dir):
    return registry.domain_health(table(spark, sf_dir, "pages").withColumn("failed", F.col("page_id") % 3 == 0))


@query("SELECT event_id FROM events WHERE epoch(TIMESTAMP '2024-01-30 00:00:00')::BIGINT - floor(epoch(ts)) < 86400 ORDER BY ts DESC, event_id LIMIT 50")
def live_cache(spark, sf_dir):
    e = activity(spark, sf_dir).withColumn("key", F.col("event_id"))
    return registry.live_cache(e, F.lit("2024-01-30 00:00:00").cast("timestamp"), 86400, 50).select("event_id")


@query(f"""WITH {ARTICLES_SQL}, t AS (SELECT source_name, pos, priority_score, row_number() OVER (PARTITION BY source_name ORDER BY pos) AS r FROM articles), k AS (SELECT * FROM t WHERE r <= 5),
w AS (SELECT a.source_name, a.pos, a.r, count(b.pos) FILTER (a.priority_score > b.priority_score) AS wins FROM k a LEFT JOIN k b ON a.source_name = b.source_name AND a.r <> b.r GROUP BY 1, 2, 3)
SELECT source_name, pos, CAST(row_number() OVER (PARTITION BY source_name ORDER BY wins DESC, r) AS INTEGER) AS new_rank FROM w""")
def pairwise_rerank(spark, sf_dir):
    ranked = articles(spark, sf_dir).withColumn("r", F.row_number().over(Window.partitionBy("source_name").orderBy("pos")))
    out = curation.pairwise_rerank(ranked, "source_name", "r", 5, lambda x, y: x["priority_score"] > y["priority_score"], ("pos", "priority_score"))
    return out.select("source_name", "pos", "new_rank")
