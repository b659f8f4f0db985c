import datetime as dt

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import scores, texts, times, urls, vectors
from broadsheet.operators import funnel


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://User:pw@WWW.Example.COM:443/A/b.git#frag", "https://www.example.com/a/b"),
        ("http://x.org:80/", "http://x.org/"),
        ("http://x.org:8080/p/?utm_source=a&b=1&b=2&ref=z&c", "http://x.org:8080/p?b=1&c="),
        ("https://x.org", "https://x.org/"),
        ("", ""),
        ("no scheme", "no scheme"),
        (None, None),
    ],
)
def test_canonical(spark, url, want):
    assert one(spark, urls.canonical(F.col("u")), u=url) == want


@pytest.mark.parametrize(("url", "want"), [("https://www.OPENAI.com/x", "openai.com"), ("https://wired.com", "ired.com"), ("https://www.", "www."), ("junk", "")])
def test_domain_strips_characters(spark, url, want):
    assert one(spark, urls.normalize_domain(F.col("u")), u=url) == want


@pytest.mark.parametrize(
    ("url", "kind", "connector"),
    [
        ("https://github.com/Apache/Spark.git", "github_repo", "github"),
        ("https://github.com/trending", "github_trending", "github"),
        ("https://rss.arxiv.org/rss/cs.SY", "arxiv", "arxiv"),
        ("https://arxiv.org/abs/2401.12345", "web", "web"),
        ("https://x.org/feed.xml", "rss", "rss"),
        ("https://x.org/a.atom", "atom", "rss"),
        ("https://x.org/blog/feed/", "rss", "rss"),
        ("https://x.org/blog", "web", "web"),
        ("ftp://x.org", None, None),
        ("", None, None),
    ],
)
def test_resolve(spark, url, kind, connector):
    got = one(spark, urls.resolve(F.col("u")), u=url)
    assert (got["source_type"], got["connector"]) == (kind, connector)


def test_source_id_by_kind(spark):
    u = F.lit("https://rss.arxiv.org/rss/cs.SY")
    assert one(spark, urls.source_id(F.lit("rss"), u), a=1) == "rss:rss.arxiv.org:cs.SY".replace("rss.arxiv.org", "rss.arxiv.org")
    assert one(spark, urls.source_id(F.lit("github"), u, F.lit("o"), F.lit("r")), a=1) == "github:o/r"
    assert one(spark, urls.source_id(F.lit("exa_search"), u, query=F.lit(" ")), a=1) == "exa_search:empty"


@pytest.mark.parametrize(
    ("text", "want"),
    [("2024-01-02T03:04:05Z", dt.datetime(2024, 1, 2, 3, 4, 5)), ("Tue, 02 Jan 2024 03:04:05 GMT", dt.datetime(2024, 1, 2, 3, 4, 5)), ("2024-01-02", dt.datetime(2024, 1, 2)), ("", None), ("soon", None), (None, None)],
)
def test_feed_dates(spark, text, want):
    assert one(spark, times.parse_feed(F.col("t")).cast("timestamp_ntz"), t=text) == want


def test_iso_week_at_year_end(spark):
    assert one(spark, times.week_label(F.lit("2027-01-01").cast("timestamp")), a=1) == "2026-W53"


@pytest.mark.parametrize(("title", "words", "want"), [("C++ news", ["c++"], True), ("a.b", ["a*b"], False), (None, ["x"], False), ("x", [], False), ("Xy", ["x"], True)])
def test_blacklist_takes_words_literally(spark, title, words, want):
    assert one(spark, texts.blacklisted(F.col("t"), F.lit(None).cast("string"), words), t=title) is want


@pytest.mark.parametrize(("text", "want"), [("train", False), ("an AI b", True), ("transformers", True)])
def test_short_excluded_words_stand_alone(spark, text, want):
    assert one(spark, texts.excluded(F.col("t"), ["AI", "transform"]), t=text) is want


def test_replies_parse_tolerantly(spark):
    schema = "a int"
    assert [r["a"] for r in one(spark, texts.parsed(F.lit('```json\n[{"a":1},{"a":2}]\n```'), schema), x=1)] == [1, 2]
    assert [r["a"] for r in one(spark, texts.parsed(F.lit('{"a":3}'), schema), x=1)] == [3]
    assert one(spark, texts.parsed(F.lit("sorry"), schema), x=1) is None


def test_vectors_guard_zero(spark):
    zero, v = F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(3.0), F.lit(4.0))
    assert one(spark, vectors.cosine(zero, v), a=1) == 0.0
    assert one(spark, vectors.norm(v), a=1) == 5.0
    assert one(spark, vectors.unit(zero), a=1) == [0.0, 0.0]


def test_score_constants(spark):
    assert one(spark, scores.recency(F.lit(0.0)), a=1) == 0.5
    assert one(spark, scores.recency(F.lit(48.0)), a=1) == 0.3333
    assert one(spark, scores.recency(F.lit(None).cast("double")), a=1) == 0.5
    assert one(spark, scores.decay(F.lit(3.0), F.lit(3.0)), a=1) == pytest.approx(0.5)
    assert one(spark, scores.decay(F.lit(None).cast("double"), F.lit(3.0)), a=1) == 1.0
    assert one(spark, scores.half_life(F.lit(1.99), F.lit(0.5)), a=1) == 3.0
    assert one(spark, scores.source_quality(F.lit("rss:openai.com")), a=1) == 0.95
    assert one(spark, scores.source_quality(F.lit("rss:x:y")), a=1) == 0.35


@pytest.mark.parametrize(("status", "error", "want"), [(150, None, "pending"), (200, None, "pass"), (302, None, "pass"), (403, None, "review"), (404, None, "reject"), (200, "timeout", "reject")])
def test_connectivity(spark, status, error, want):
    assert one(spark, funnel.connectivity(F.col("s"), F.col("e")), s=status, e=error) == want


@pytest.mark.parametrize(
    ("endpoint", "want"),
    [("", "empty_endpoint"), ("ftp://a.b", "invalid_scheme: ftp"), ("https://localhost", "invalid_domain: localhost"), ("https://amazon.com/x", "blocked_domain: amazon.com"), ("https://a.b.amazon.com", "blocked_parent_domain: amazon.com"), ("https://ok.org", "structural_valid")],
)
def test_structure(spark, endpoint, want):
    assert one(spark, funnel.structure_reason(F.col("e"), F.lit("web")), e=endpoint) == want
