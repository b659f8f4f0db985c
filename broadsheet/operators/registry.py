"""Sources over time: weekly evaluation, capped merging, mining of new sources, sampling and routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls


def evaluate(sources: DataFrame, counts: DataFrame, min_weekly: int = 0, stale_weeks: int = 4, protected: tuple[str, ...] = (), key: str = "name") -> DataFrame:
    """One evaluation round: sources (key, connector, eval_score, streak, active) left-joined with weekly counts (key, n)."""
    joined = sources.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    skip = F.col("connector").isin(*protected) if protected else F.lit(False)
    good, none = (F.col("n") >= min_weekly) & (F.col("n") > 0), F.col("n") == 0
    score = F.when(skip, F.col("eval_score")).when(good, F.least(F.col("eval_score") + 1, F.lit(10))).when(none, F.col("eval_score") - 2).otherwise(F.col("eval_score") - 1)
    streak = F.when(skip, F.col("streak")).when(good, 0).when(none, F.col("streak") + 1).otherwise(0)
    return joined.withColumn("new_score", score).withColumn("new_streak", streak).withColumn("new_active", F.col("active") & (skip | (F.col("new_streak") < stale_weeks)))


def streaks(history: DataFrame, key: str, week: str, count: str = "n") -> DataFrame:
    """Consecutive weeks without output up to each week of the history."""
    order = Window.partitionBy(key).orderBy(week)
    island = F.sum((F.col(count) > 0).cast("int")).over(order)
    return history.withColumn("_island", island).withColumn("streak", F.count_if(F.col(count) == 0).over(Window.partitionBy(key, "_island").orderBy(week))).drop("_island")


def merge_capped(existing: DataFrame, found: DataFrame, key: str, capacity: int, order: list[Column]) -> DataFrame:
    """Existing sources and the first of the new ones, up to a capacity that archived sources count towards."""
    fresh = found.join(existing.select(key), key, "left_anti")
    room = existing.agg(F.greatest(F.lit(0), F.lit(capacity) - F.count(F.lit(1))).alias("room"))
    numbered = fresh.orderBy(*order).limit(capacity).withColumn("_i", F.row_number().over(Window.orderBy(*order)))
    taken = numbered.join(F.broadcast(room), F.col("_i") <= F.col("room")).drop("_i", "room")  # at most capacity rows and one
    return existing.withColumn("added", F.lit(False)).unionByName(taken.withColumn("added", F.lit(True)), allowMissingColumns=True)


def mined_links(pages: DataFrame, known: DataFrame | None, id_col: str, links: Column, category: str | None = None) -> DataFrame:
    """Domains that pages link to: linking rows, distinct URLs, the category that most of them have (the first by name wins a tie); known domains left out."""
    out = pages.select(F.col(id_col).alias("id"), *([F.col(category).alias("category")] if category else []), F.explode(links).alias("url")).withColumn("domain", urls.service_domain(F.col("url"))).where(F.col("domain") != "")
    if known is not None:
        out = out.join(known.select("domain"), "domain", "left_anti")
    found = out.groupBy("domain").agg(F.count_distinct("url").alias("urls"), F.count_distinct("id").alias("refs"), F.min("url").alias("first_url")).withColumn("weight", F.least(F.lit(5) + F.col("urls"), F.lit(8)))
    if not category:
        return found
    counted = out.groupBy("domain", "category").agg(F.count_distinct("id").alias("n"))
    return found.join(counted.groupBy("domain").agg(F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("category")), "domain", "left")


def top_terms(rows: DataFrame, terms: Column, n: int = 5) -> DataFrame:
    return rows.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(n)


def stratified_sample(rows: DataFrame, stratum: str, key: Column, n: int) -> DataFrame:
    """About n rows, each stratum's share rounded half to even and at least one, chosen by the order of a hash."""
    share = Window.partitionBy(stratum)
    total = rows.agg(F.count(F.lit(1)).alias("_total"))
    sizes = rows.groupBy(stratum).agg(F.count(F.lit(1)).alias("_n")).join(F.broadcast(total)).withColumn("_take", F.greatest(F.lit(1), F.bround(F.lit(n) * F.col("_n") / F.col("_total")).cast("int")))
    ranked = rows.withColumn("_key", key).withColumn("_rank", F.row_number().over(share.orderBy("_key")))
    picked = ranked.join(sizes.select(stratum, "_take"), stratum).where(F.col("_rank") <= F.col("_take"))
    return picked.orderBy("_rank", "_key").limit(n).drop("_key", "_rank", "_take")


def split_connectors(sources: DataFrame, search: tuple[str, ...] = ("exa_search",)) -> tuple[DataFrame, DataFrame]:
    """Active sources that are fetched first, and those that search and are anti-joined with what the first gave."""
    active = sources.where(F.coalesce("active", F.lit(True)))
    return active.where(~F.coalesce("connector", F.lit("")).isin(*search)), active.where(F.col("connector").isin(*search))


def two_stage_union(stable: DataFrame, searched: DataFrame, url: str = "url") -> DataFrame:
    return stable.unionByName(searched.join(stable.select(url), url, "left_anti"), allowMissingColumns=True)


def aliased(rows: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Both names of every alias pair, each filled from whichever is there."""
    for name, other in pairs.items():
        have = [F.col(c) for c in (name, other) if c in rows.columns]
        if have:
            rows = rows.withColumns({name: F.coalesce(*have), other: F.coalesce(*have)})
    return rows


def with_runtime(static: DataFrame, runtime: DataFrame, key: str = "id") -> DataFrame:
    """Static configuration left-joined with runtime state, which only fills what is missing."""
    shared = [c for c in runtime.columns if c in static.columns and c != key]
    renamed = runtime.withColumnsRenamed({c: f"_r_{c}" for c in shared})
    joined = static.join(renamed, key, "left")
    return joined.withColumns({c: F.coalesce(c, f"_r_{c}") for c in shared}).drop(*[f"_r_{c}" for c in shared])


# ---- the request log ---------------------------------------------------------------------------------
def domain_health(requests: DataFrame, dead_at: int = 3) -> DataFrame:
    """(domain, failures, dead) of a request log (url, failed)."""
    return requests.groupBy(urls.normalize_domain(F.col("url")).alias("domain")).agg(F.count_if("failed").alias("failures")).withColumn("dead", F.col("failures") >= dead_at)


def rate(requests: DataFrame, key: str, ts: str, seconds: int, most: int) -> DataFrame:
    """Requests of the same key within the last seconds, this one included, and whether they exceed the limit."""
    frame = Window.partitionBy(key).orderBy(F.unix_seconds(F.col(ts).cast("timestamp"))).rangeBetween(-seconds, 0)
    return requests.withColumn("in_window", F.count(F.lit(1)).over(frame)).withColumn("over", F.col("in_window") > most)


def live_cache(entries: DataFrame, as_of: Column, ttl_seconds: int = 3600, most: int = 500) -> DataFrame:
    """Cache entries (key, ts) younger than the time to live, the newest `most` of them."""
    return entries.where(F.unix_seconds(as_of) - F.unix_seconds("ts") < ttl_seconds).orderBy(F.desc("ts"), "key").limit(most)
