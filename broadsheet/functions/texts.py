"""Text columns: cleaning, keyword tests, categories and tolerant JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: preview lengths by source type, topic names and words that tell relevance or promotion
PREVIEW = {"arxiv": 2000, "web": 1200, "wechat": 1000, "github": 600, "hf": 600}
PREVIEW_DEFAULT = 800
PLATFORM = {"rss": "web", "arxiv": "arxiv", "github": "github", "exa_search": "web", "web": "web"}
TOPIC_WORDS = ("AI", "LLM", "agent", "model", "training", "transformer", "simulation", "digital twin", "CAD", "CFD", "generative", "diffusion", "reinforcement learning", "fine-tune", "fine-tuning", "embedding", "inference", "RAG", "MCP", "大模型", "智能体", "仿真", "孪生", "生成式", "微调", "推理")
PROMO_WORDS = ("subscribe now", "click here", "buy now", "limited time", "free trial", "sign up today", "discount")
# end of fixed values


def sanitize(text: Column, most: int = 2000) -> Column:
    return F.nullif(F.left(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(most)), F.lit(""))


def strip_html(text: Column, most: int | None = None) -> Column:
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]+>", " "), r"\s+", " "))
    return F.nullif(F.left(bare, F.lit(most)) if most else bare, F.lit(""))


def lookup(table: dict[str, object], key: Column, default: Column | object) -> Column:
    """A literal table's value for a key, or a default."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default if isinstance(default, Column) else F.lit(default))


def preview(text: Column, source_type: Column) -> Column:
    return F.substr(text, F.lit(1), lookup(PREVIEW, source_type, PREVIEW_DEFAULT))


def platform(connector: Column) -> Column:
    return lookup(PLATFORM, connector, "web")


def category_name(category: Column, names: dict[str, str]) -> Column:
    """A category by its other name; unknown ones stay."""
    return lookup(names, category, category)


def _any(words: tuple[str, ...] | list[str]) -> str:
    return "(?i)(?:" + "|".join(r"\Q" + w.replace(r"\E", r"\E\\E\Q") + r"\E" for w in words) + ")"


def blacklisted(title: Column, summary: Column, words: list[str]) -> Column:
    """Whether a keyword, taken literally and in any case, is in the title or the summary's first 200 characters. No keywords: never."""
    if not words:
        return F.lit(False)
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.left(F.coalesce(summary, F.lit("")), F.lit(200))).rlike(_any(words))


def excluded(text: Column, words: list[str]) -> Column:
    """Short words (up to 4 characters) must stand alone, longer ones may be anywhere."""
    if not words:
        return F.lit(False)
    parts = [rf"\b\Q{w}\E\b" if len(w) <= 4 else rf"\Q{w}\E" for w in words]
    return text.rlike("(?U)(?i)(?:" + "|".join(parts) + ")")


def included(text: Column, patterns: list[str]) -> Column:
    """Whether any regular expression matches, in any case; without patterns everything does."""
    return text.rlike("(?i)(?:" + "|".join(patterns) + ")") if patterns else F.lit(True)


def hits(text: Column, words: tuple[str, ...]) -> Column:
    """How many of the distinct words the text contains, in any case."""
    low = F.lower(text)
    return sum((F.contains(low, F.lit(w)).cast("int") for w in dict.fromkeys(w.lower() for w in words)), F.lit(0))


def is_academic(source_name: Column) -> Column:
    return F.coalesce(source_name.rlike("(?i)arxiv|nature"), F.lit(False))


def cross_domain(text: Column, categories: list[str], least: int = 2) -> Column:
    return hits(F.coalesce(text, F.lit("")), tuple(categories)) >= least


def unfenced(reply: Column) -> Column:
    """A model's reply without the fence of a code block."""
    return F.trim(F.regexp_replace(F.trim(reply), r"(?s)^```[A-Za-z]*\s*|\s*```$", ""))


def parsed(reply: Column, schema: str) -> Column:
    """The reply as array<struct>; one object counts as an array of one; what is no JSON is NULL."""
    return F.from_json(unfenced(reply), f"array<struct<{schema}>>")


def front_matter_free(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---.*?---\s*", "")


def slug(name: Column, table: dict[str, str]) -> Column:
    return lookup(table, name, F.replace(F.lower(name), F.lit(" "), F.lit("-")))


def short_label(text: Column, most: int = 8) -> Column:
    return F.left(F.regexp_replace(text, r"[\s\p{Punct}，。、：；！？“”‘’（）《》]", ""), F.lit(most))


def capped_words(text: Column, most: int = 512) -> Column:
    """The first words of a text; a model's own token window is not reproduced."""
    return F.array_join(F.slice(F.split(text, r"\s+"), 1, most), " ")
