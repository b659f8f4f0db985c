"""Score columns for events, sources and candidates. Constants keep their published values."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import lookup

# fixed values: half-lives in days, and trust in a publisher by domain
BREAKING_DAYS, DEEP_DAYS, RECENCY_HOURS = 3.0, 14.0, 48.0
UNKNOWN_SOURCE = 0.35
SOURCE_QUALITY = {
    "openai.com": 0.95, "deepmind.google": 0.95, "ai.google": 0.95, "arxiv.org": 0.9, "nvidia.com": 0.9, "microsoft.com": 0.9, "meta.com": 0.9,
    "anthropic.com": 0.95, "huggingface.co": 0.9, "nelp.com": 0.9, "mistral.ai": 0.9, "x.ai": 0.9, "neurips.cc": 0.9, "iclr.cc": 0.9, "cvpr": 0.9,
    "aclanthology.org": 0.85, "ieee.org": 0.85, "acm.org": 0.85, "ijcai.org": 0.85, "icml.cc": 0.85, "aaai.org": 0.85, "emnlp.org": 0.85,
    "techcrunch.com": 0.7, "theverge.com": 0.7, "wired.com": 0.7, "venturebeat.com": 0.65, "reuters.com": 0.8, "bloomberg.com": 0.8, "bntnews.com": 0.7,
    "github.com": 0.8, "medium.com": 0.5, "substack.com": 0.4, "twitter.com": 0.3, "x.com": 0.3, "reddit.com": 0.2,
}
# end of fixed values


def unit_range(x: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))  # greatest and least skip nulls


def coverage(n: Column) -> Column:
    return F.round(F.least(n / F.lit(5.0), F.lit(1.0)), 4)


def recency(hours: Column) -> Column:
    """0.5 at hour 0 and a third at RECENCY_HOURS; 0.5 without a date."""
    return F.round(F.coalesce(1 / (1 + F.exp(F.lit(math.log(2) / RECENCY_HOURS) * hours)), F.lit(0.5)), 4)


def source_quality(source_id: Column) -> Column:
    """The trust of what follows the id's first colon, in any case."""
    return lookup(SOURCE_QUALITY, F.lower(F.regexp_replace(source_id, "^[^:]*:", "")), UNKNOWN_SOURCE)


def half_life(span_days: Column, importance: Column) -> Column:
    return F.when((span_days >= 2) | (importance >= 7), F.lit(DEEP_DAYS)).otherwise(F.lit(BREAKING_DAYS))


def decay(days: Column, life: Column) -> Column:
    """Halves every `life` days from the first article on, never below 0.01; 1 without a date."""
    return F.when(days.isNull(), F.lit(1.0)).otherwise(F.greatest(F.exp(F.lit(-math.log(2)) * days / life), F.lit(0.01)))


def llm_part(importance: Column, impact: Column, novelty: Column) -> Column:
    return unit_range(importance) * 0.3 + unit_range(impact) * 0.25 + unit_range(novelty) * 0.15


def objective_part(covered: Column, diversity: Column, recent: Column) -> Column:
    return covered * 0.25 + diversity * 0.1 + recent * 0.05


def final_score(llm: Column, objective: Column, n: Column, decayed: Column) -> Column:
    return F.round((llm * 0.6 + objective * 0.4) * F.least(n / F.lit(4.0), F.lit(1.0)) * decayed, 4)


def weighted(importance: Column, impact: Column, novelty: Column) -> Column:
    return importance * 0.4 + impact * 0.3 + novelty * 0.3


def event_importance(mean_priority: Column, n: Column) -> Column:
    return F.round(F.least(mean_priority / 10 * 0.6 + F.least(n / F.lit(3.0), F.lit(1.0)) * 0.4, F.lit(1.0)), 3)
