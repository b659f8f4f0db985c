"""The candidate funnel: structure, connectivity, extraction and relevance as successive column groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts, urls

# fixed values: connectors that exist, and domains that are never sources
CONNECTORS = ("rss", "web", "arxiv", "github", "exa_search")
BLOCKED = ("ads.google.com", "analytics.google.com", "cloudflare.com", "cdn.cloudflare.com", "buzzfeed.com", "listverse.com", "amazon.com", "calendly.com")
# end of fixed values

PASS, REVIEW, REJECT, PENDING = "pass", "review", "reject", "pending"


def structure_reason(endpoint: Column, connector: Column, connectors: tuple[str, ...] = CONNECTORS, blocked: tuple[str, ...] = BLOCKED, blocked_parents: tuple[str, ...] | None = None) -> Column:
    """The first rule a candidate breaks, or structural_valid. Domains below blocked_parents, all blocked ones unless given, are blocked as well."""
    bare, name = F.coalesce(F.trim(endpoint), F.lit("")), urls.host(F.coalesce(endpoint, F.lit("")))
    labels = F.split(name, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = F.array_intersect(parents, F.array(*map(F.lit, blocked if blocked_parents is None else blocked_parents)))
    kind = F.coalesce(connector, F.lit("web"))
    return (
        F.when(bare == "", F.lit("empty_endpoint"))
        .when(~urls.scheme(bare).isin("http", "https"), F.concat(F.lit("invalid_scheme: "), urls.scheme(bare)))
        .when((name == "") | ~F.contains(name, F.lit(".")), F.concat(F.lit("invalid_domain: "), name))
        .when(~kind.isin(*connectors), F.concat(F.lit("no_connector: "), kind))
        .when(name.isin(*blocked), F.concat(F.lit("blocked_domain: "), name))
        .when(F.size(found) > 0, F.concat(F.lit("blocked_parent_domain: "), F.try_element_at(found, F.lit(1))))
        .otherwise(F.lit("structural_valid"))
    )


def structural_hints(endpoint: Column) -> Column:
    low = F.lower(urls.path(endpoint))
    feed = low.rlike(r"\.(rss|xml)$") | F.contains(low, F.lit("/feed")) | F.contains(low, F.lit("/rss/"))
    atom = F.contains(low, F.lit("/atom")) | low.endswith(".atom")
    return F.array_compact(F.array(F.when(feed, F.lit("rss_feed")), F.when(atom, F.lit("atom_feed")), F.when(urls.host(endpoint).endswith("arxiv.org"), F.lit("arxiv_source"))))


def connectivity(http_status: Column, error_type: Column) -> Column:
    return F.when(error_type.isNotNull(), REJECT).when(http_status.between(200, 399), PASS).when(http_status == 403, REVIEW).when(http_status >= 400, REJECT).otherwise(PENDING)


def extraction(n_articles: Column, title: Column, summary: Column) -> Column:
    enough = (F.length(F.coalesce(summary, F.lit(""))) > 50) | (n_articles > 3)
    return F.when(F.coalesce(n_articles, F.lit(0)) == 0, REJECT).when((F.coalesce(title, F.lit("")) != "") & enough, PASS).otherwise(REVIEW)


def relevance(content: Column, topic: tuple[str, ...] = texts.TOPIC_WORDS, promo: tuple[str, ...] = texts.PROMO_WORDS, most_links: float | None = 0.1) -> Column:
    """struct(topic_hits, spam_score, status) of a content sample. More links a word than most_links (None: any number is well) tell spam."""
    sample = F.coalesce(content, F.lit(""))
    n = texts.hits(sample, topic)
    words = F.size(F.filter(F.split(sample, r"\s+"), lambda w: w != ""))
    links = F.regexp_count(sample, F.lit("http"))
    linked = F.lit(False) if most_links is None else (words > 0) & (links / F.greatest(words, F.lit(1)) > most_links)
    spam = F.when(texts.hits(sample, promo) >= 3, 0.4).otherwise(0.0) + F.when(F.length(sample) < 200, 0.2).otherwise(0.0) + F.when(linked, 0.3).otherwise(0.0)
    score = F.round(F.least(F.lit(1.0), spam), 6)
    status = F.when(sample == "", REVIEW).when((n >= 3) & (score < 0.3), PASS).when((n >= 3) | (score < 0.3), REVIEW).otherwise(REJECT)
    return F.struct(F.when(sample == "", 0).otherwise(n).alias("topic_hits"), F.when(sample == "", 0.0).otherwise(score).alias("spam_score"), status.alias("status"))


def funnel(candidates: DataFrame, probes: DataFrame | None = None, blocked: tuple[str, ...] = BLOCKED, blocked_parents: tuple[str, ...] | None = None, promo: tuple[str, ...] = texts.PROMO_WORDS, most_links: float | None = 0.1) -> DataFrame:
    """Candidates (endpoint, connector, category) with probe columns, decided stage by stage.

    Probe columns are http_status, response_time_ms, error_type, n_articles, first_title and first_summary, of the
    candidates themselves or of a table joined by endpoint. A stage after a rejection stays null and the score 0.
    points is the same sum as the score before that is held within 0 and 100; all there is to win makes 105.
    """
    rows = candidates if probes is None else candidates.join(probes, "endpoint", "left")
    l0 = F.when(F.col("l0_reason") == "structural_valid", PASS).otherwise(REJECT)
    staged = rows.withColumn("l0_reason", structure_reason(F.col("endpoint"), F.col("connector"), blocked=blocked, blocked_parents=blocked_parents)).withColumn("l0", l0)
    staged = staged.withColumn("l1", F.when(F.col("l0") == PASS, connectivity(F.col("http_status"), F.col("error_type"))))
    staged = staged.withColumn("l2", F.when(F.col("l1") != REJECT, extraction(F.col("n_articles"), F.col("first_title"), F.col("first_summary"))))
    staged = staged.withColumn("_l3", F.when(F.col("l2") != REJECT, relevance(F.left(F.col("first_summary"), F.lit(500)), promo=promo, most_links=most_links)))
    decision = F.coalesce("_l3.status", F.lit(REJECT))
    score = (
        F.when(F.col("http_status").between(200, 399), 20).otherwise(0)
        + F.when(F.col("response_time_ms") < 2000, 10).otherwise(0)
        + F.when(F.col("l2") == PASS, 30).otherwise(0)
        + F.when(F.coalesce("first_title", F.lit("")) != "", 5).otherwise(0)
        + F.when(F.length(F.coalesce("first_summary", F.lit(""))) > 50, 15).otherwise(0)
        + F.when(F.col("_l3.topic_hits") >= 3, 25).otherwise(0)
        - F.floor(F.col("_l3.spam_score") * 20)
    )
    staged = staged.withColumn("points", F.when(F.col("_l3").isNull(), 0).otherwise(score).cast("int"))
    bounded = F.greatest(F.lit(0), F.least(F.lit(100), F.col("points")))
    return staged.withColumns({"l3": F.col("_l3.status"), "spam_score": F.col("_l3.spam_score"), "decision": decision, "score": bounded}).drop("_l3")


def as_sources(decided: DataFrame) -> DataFrame:
    """Passed candidates as sources: weight a tenth of the score within 1 and 10, trust 0.5."""
    weight = F.least(F.lit(10), F.greatest(F.lit(1), F.floor(F.col("score") / 10).cast("int")))
    # exploded, the decision is a value: Spark would push a filter on it below the stages, which it then works out anew wherever they are named
    passed = decided.withColumn("_passed", F.explode(F.array(F.col("decision") == PASS))).where("_passed").drop("_passed")
    return passed.withColumns({"weight": weight, "trust": F.lit(0.5), "eval_score": F.col("score")})


def fresh_candidates(candidates: DataFrame, existing: DataFrame, by: str = "endpoint", order: str = "pos") -> DataFrame:
    """The first candidate of each endpoint that no source has."""
    from .dedup import first_wins

    return first_wins(candidates, by, order).join(existing.select(by), by, "left_anti")


def decision_json(decided: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(c) for c in ("decision", "score", "l0", "l0_reason", "l1", "l2", "l3", "spam_score")]))
