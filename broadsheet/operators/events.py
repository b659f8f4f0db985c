"""Events built from clustered articles: aggregation, scores, ranking, carry-over and the report's joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scores, times, vectors

UNCATEGORIZED = "Uncategorized"


def category_of(column: Column) -> Column:
    return F.coalesce(F.nullif(column, F.lit("")), F.lit(UNCATEGORIZED))


def category_mode(rows: DataFrame, event: str, category: str = "category", pos: str = "pos") -> DataFrame:
    """Each event's most frequent category; the one met first wins a tie."""
    counted = rows.groupBy(event, category_of(F.col(category)).alias("category")).agg(F.count(F.lit(1)).alias("n"), F.min(pos).alias("first"))
    return counted.groupBy(event).agg(F.max_by(F.struct("category", "n"), F.struct("n", -F.col("first"))).alias("top")).select(event, F.col("top.category").alias("category"), F.col("top.n").alias("n"))


def representatives(rows: DataFrame, event: str, score: str = "priority_score", pos: str = "pos", columns: tuple[str, ...] = ("pos", "title")) -> DataFrame:
    """Each event's article with the highest score (5 where it has none); the first wins a tie."""
    best = F.max_by(F.struct(*columns), F.struct(F.coalesce(F.col(score), F.lit(5)), -F.col(pos)))
    return rows.groupBy(event).agg(best.alias("top")).select(event, "top.*")


def build_events(rows: DataFrame, event: str, pos: str = "pos") -> DataFrame:
    """One row for each event: title, size, mean priority, importance, sources, category. Two aggregations of one key."""
    priority = F.coalesce(F.col("priority_score"), F.lit(5))
    base = rows.groupBy(event).agg(
        F.max_by(F.struct("title", "url"), F.struct(priority, -F.col(pos))).alias("lead"),
        F.count(F.lit(1)).alias("n_articles"),
        F.avg(priority).alias("mean_priority"),
        F.array_join(F.array_sort(F.collect_set("source_name")), ", ").alias("source_names"),
        F.count_distinct("source_name").alias("source_count"),
        F.array_sort(F.collect_list(pos)).alias("article_pos"),
    )
    return base.join(category_mode(rows, event, pos=pos).drop("n"), event).select(
        event, F.col("lead.title").alias("title"), "category", "n_articles", "mean_priority", scores.event_importance(F.col("mean_priority"), F.col("n_articles")).alias("importance"), "source_names", "source_count", "article_pos"
    )


def objective_metrics(rows: DataFrame, keys: list[str], as_of: Column, published: Column, source_id: str = "source_id", content: Column | None = None, summary: Column | None = None) -> DataFrame:
    """Coverage, recency, diversity, source and article quality, span and age of each event, in one aggregation."""
    ratio = F.lit(None).cast("double") if content is None or summary is None else F.when(F.length(summary) > 0, F.least(F.length(content) / F.length(summary), F.lit(5.0)) / 5)
    source = F.nullif(F.col(source_id), F.lit(""))
    found = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(source).alias("sources"),
        F.max(published).alias("latest"),
        F.min(published).alias("earliest"),
        F.coalesce(F.max(F.when(source.isNotNull(), scores.source_quality(source))), F.lit(scores.UNKNOWN_SOURCE)).alias("source_quality"),
        F.round(F.coalesce(F.avg(ratio), F.lit(0.0)), 4).alias("article_quality"),
    )
    hours = times.seconds_between(as_of, F.col("latest")) / 3600.0
    return found.select(
        *keys, "n", "sources",
        scores.coverage(F.col("n")).alias("coverage"),
        scores.recency(hours).alias("recency"),
        F.round(F.col("sources") / F.col("n"), 4).alias("source_diversity"),
        F.round("source_quality", 4).alias("source_quality"),
        "article_quality",
        F.round(F.coalesce(times.seconds_between(F.col("latest"), F.col("earliest")) / 86400.0, F.lit(0.0)), 2).alias("span_days"),
        (times.seconds_between(as_of, F.col("earliest")) / 86400.0).alias("age_days"),
    )


def score_events(metrics: DataFrame, importance: Column, novelty: Column, impact: Column) -> DataFrame:
    """Adds half_life, time_decay, both parts, confidence and final_score."""
    return (
        metrics.withColumn("half_life", scores.half_life(F.col("span_days"), importance))
        .withColumn("_decay", scores.decay(F.col("age_days"), F.col("half_life")))
        .withColumn("_llm", scores.llm_part(importance, impact, novelty))
        .withColumn("_objective", scores.objective_part(F.col("coverage"), F.col("source_diversity"), F.col("recency")))
        .withColumn("final_score", scores.final_score(F.col("_llm"), F.col("_objective"), F.col("n"), F.col("_decay")))
        .withColumn("time_decay", F.round("_decay", 4))
        .withColumn("llm_part", F.round("_llm", 4))
        .withColumn("obj_part", F.round("_objective", 4))
        .withColumn("confidence", F.round(F.least(F.col("n") / 4.0, F.lit(1.0)), 4))
        .drop("_decay", "_llm", "_objective")
    )


def top_n(events: DataFrame, by: str, order: list[Column], n: int = 50) -> DataFrame:
    """The first n events of each category, numbered. Spark keeps n rows a task before the shuffle."""
    return events.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= n)


def carry_over(events: DataFrame, week: str, back: int = 4, week_col: str = "week_label", category_col: str = "category") -> DataFrame:
    """A week's events, and for a category without any those of its nearest of the last `back` recorded weeks.

    Nothing is carried over into a week without events.
    """
    weeks = events.select(week_col).distinct()
    number = F.dense_rank().over(Window.orderBy(F.desc(week_col)))
    placed = weeks.where(F.col(week_col) <= week).withColumn("offset", number - 1)
    current = placed.where((F.col("offset") == 0) & (F.col(week_col) == week))
    recent = placed.where(F.col("offset") <= back)  # at most back + 1 rows
    known = events.join(F.broadcast(recent), week_col)
    nearest = known.groupBy(category_col).agg(F.min("offset").alias("nearest"))
    kept = known.join(nearest, category_col).where(F.col("offset") == F.col("nearest")).drop("nearest")
    return kept.join(current.select(F.col(week_col).alias("_week")), F.lit(True), "left_semi").withColumn("carried_over", F.col("offset") > 0)


def centroid_nearest(rows: DataFrame, group: str, id_col: str, vector_col: str, k: int, dimensions: int) -> DataFrame:
    """The k rows nearest to the normalised mean vector of their group; all of a group of at most k, in id order.

    The mean is an aggregate by dimension in plain columns, so that a large group is reduced map-side.
    """
    wide = rows.select(group, id_col, F.col(vector_col).alias("_v"))
    sums = wide.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), *[F.avg(F.col("_v")[i].cast("double")).alias(f"_{i}") for i in range(dimensions)])
    centre = sums.select(group, "_n", vectors.unit(F.array(*[f"_{i}" for i in range(dimensions)])).alias("_c"))
    placed = wide.join(centre, group).withColumn("dist2", vectors.squared_distance(F.col("_v"), F.col("_c")))
    order = [F.when(F.col("_n") > k, F.col("dist2")), F.col(id_col)]
    return placed.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k).select(group, id_col, "rank", "dist2")


def stats_line(rows: DataFrame, event: str, published: Column, source_id: str = "source_id") -> DataFrame:
    """Articles, distinct sources and hours between first and last article (0 below an hour, or where a date is missing)."""
    found = rows.groupBy(event).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce(F.col(source_id), F.lit(""))).alias("sources"), F.min(published).alias("first"), F.max(published).alias("last"), F.count_if(published.isNull()).alias("undated"))
    hours = times.seconds_between(F.col("last"), F.col("first")) / 3600
    return found.select(event, "n", "sources", F.when((F.col("undated") > 0) | (hours < 1), F.lit(0.0)).otherwise(hours).alias("hours"))


def prompt_blocks(rows: DataFrame, event: str, pos: str = "pos", most: int = 20, chars: int = 400) -> DataFrame:
    """Each event's numbered article list as one text for a model's prompt."""
    first = rows.withColumn("_i", F.row_number().over(Window.partitionBy(event).orderBy(pos)) - 1).where(F.col("_i") < most)
    line = F.concat(F.lit("["), F.col("_i").cast("string"), F.lit("] "), F.col("title"), F.lit(" (from "), F.col("source_name"), F.lit(")\n"), F.left(F.coalesce("summary", F.lit("")), F.lit(chars)))
    return first.groupBy(event).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_i"), line.alias("line")))), lambda x: x["line"]), "\n").alias("block"))


def gather(events: DataFrame, articles: DataFrame, positions: str = "article_pos", pos: str = "pos", event: str = "event_id") -> DataFrame:
    """The articles of each event by position, positions out of range dropped: (event, ordinal, article columns)."""
    return events.select(event, F.posexplode(positions).alias("ordinal", pos)).join(articles, pos)


def fallback_curation(events: DataFrame, names: dict[str, str]) -> DataFrame:
    """What curation gives without a model: scores of 0.5, the event's own title and category, relevant."""
    from ..functions.texts import category_name

    half = F.lit(0.5)
    return events.withColumns({"is_relevant": F.lit(True), "curated_category": category_name(F.col("category"), names), "novelty": half, "impact": half, "curated_importance": half})


def curated(events: DataFrame, replies: DataFrame, batch: str = "batch_id", ordinal: str = "event_index") -> DataFrame:
    """Events with a model's parsed reply by batch and ordinal; scores clamped, missing replies at their defaults, irrelevant events dropped."""
    joined = events.join(replies, [batch, ordinal], "left")
    clamp = lambda c: scores.unit_range(F.coalesce(F.col(c), F.lit(0.5)))
    return joined.withColumns({c: clamp(c) for c in ("importance", "novelty", "impact")}).where(F.coalesce("is_relevant", F.lit(True)))


def valid_evidence(indices: Column, n: Column, most: int = 3) -> Column:
    return F.slice(F.filter(indices, lambda i: (i >= 0) & (i < n)), 1, most)


# ---- the report's joins ----------------------------------------------------------------------------
def event_articles(events: DataFrame, bridge: DataFrame, articles: DataFrame) -> DataFrame:
    """The distinct (event, article) rows of the events given: one equi-join instead of a lookup for each event."""
    return events.join(bridge.select("event_id", "article_url").distinct(), "event_id").join(articles, F.col("article_url") == articles["url"])


def evidence_chain(events: DataFrame, bridge: DataFrame, articles: DataFrame, sources: DataFrame) -> DataFrame:
    """Event, its articles and their sources; an article of an unknown source keeps a null source."""
    return event_articles(events, bridge, articles).join(sources, "source_id", "left")


def report_totals(events: DataFrame) -> DataFrame:
    return events.groupBy("category").agg(F.count(F.lit(1)).alias("events"), F.sum("n_articles").alias("articles"), F.bool_or("carried_over").alias("has_carried"))


def fuzzy_category(rows: DataFrame, configured: DataFrame, category: str = "category", other: str = "LLM") -> DataFrame:
    """The first configured category (name, ord) that contains or is contained in the row's; `other` where none does.

    Distinct categories are few, so only they are compared, and the answer is joined back.
    """
    names = rows.select(category).where(F.col(category).isNotNull()).distinct()
    hit = F.contains(F.col(category), F.col("name")) | F.contains(F.col("name"), F.col(category))
    best = names.join(F.broadcast(configured), hit, "left").groupBy(category).agg(F.min_by("name", "ord").alias("report_category"))
    return rows.join(best, category, "left").withColumn("report_category", F.coalesce("report_category", F.lit(other)))
