"""Scans of landed files against what they should give, row by row."""

import json

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import funnel
from broadsheet.plans import catalog, table_queries
from broadsheet.sources import readers
from broadsheet.streaming import state
from tests.oracle import connected, same


def landed(path, rows):
    path.mkdir()
    (path / "part.json").write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    return str(path)


def test_papers_newest_first(spark, tmp_path):
    rows = [{"url": f"u{i}", "title": f"t{i}", "summary": "s" * 4000, "published": f"2024-01-{i + 1:02}T00:00:00Z", "authors": [f"a{j}" for j in range(i)], "category": f"http://x/cs.{i}"} for i in range(12)]
    rows.append({"url": "late", "title": "t", "updated": "2024-02-01T00:00:00Z", "published": "2020-01-01T00:00:00Z", "category": "plain"})
    got = readers.papers(spark, landed(tmp_path / "papers", rows)).collect()
    assert [r.url for r in got] == ["late", *(f"u{i}" for i in range(11, 2, -1))]
    assert (got[1].author, got[1].category, len(got[1].summary)) == ("a0, a1, a2, a3, a4", "cs.11", 3000)
    assert (got[0].category, got[0].summary) == ("plain", None)


def test_releases_of_the_last_days(spark, tmp_path):
    rows = [
        {"html_url": "new", "name": "", "tag_name": "v2", "body": "b" * 4000, "published_at": "2024-01-30T00:00:00Z", "assets": [{"name": f"f{i}", "size": i} for i in range(12)]},
        {"html_url": "named", "name": "Two", "tag_name": "v2", "body": None, "published_at": "2024-01-24T00:00:00Z", "assets": []},
        {"html_url": "old", "name": "One", "tag_name": "v1", "body": "", "published_at": "2024-01-01T00:00:00Z", "assets": []},
    ]
    got = {r.url: r for r in readers.releases(spark, landed(tmp_path / "releases", rows), F.lit("2024-01-31 00:00:00").cast("timestamp")).collect()}
    assert set(got) == {"new", "named"}
    assert (got["new"].title, len(got["new"].summary), len(got["new"].assets)) == ("Release: v2", 3000, 10)
    assert (got["named"].title, got["named"].summary) == ("Release: Two", None)


def test_article_records_split_good_and_bad(spark, tmp_path):
    good = {"url": "u", "title": "t", "source_id": "s", "source_name": "S", "source_type": "rss"}
    folder = tmp_path / "articles"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([good, good | {"title": None}, {"url": "x"}]))
    kept, bad = readers.article_records(spark, str(folder))
    assert [r.url for r in kept.collect()] == ["u"]
    assert sorted(r.url for r in bad.collect()) == ["u", "x"]


def test_streams_of_failures_and_undated_rows(spark, tmp_path):
    rows = [("a", True, "2024-01-01 00:00:00"), ("a", True, "2024-01-02 00:00:00"), ("b", True, "2024-01-01 00:00:00"), ("b", False, "2024-01-02 00:00:00"), ("c", False, None)]
    spark.createDataFrame(rows, "host string, failed boolean, ts string").select("host", "failed", F.col("ts").cast("timestamp").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("host string, failed boolean, ts timestamp").parquet(str(tmp_path / "in"))
    dated = state.dated(stream, "ts", F.lit("2024-01-03 00:00:00").cast("timestamp"))
    got, merged, done = [], [], set()
    sink = state.idempotent_sink(lambda df: merged.extend(r.key for r in df.collect()), done.__contains__, done.add)

    def batch(df, n):
        got.extend(tuple(r) for r in df.collect())
        sink(df, n)
        sink(df, n)

    state.failure_streaks(dated, "host", "failed", "ts").writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(batch).trigger(availableNow=True).start().awaitTermination()
    assert sorted(got) == [("a", 2), ("b", 0), ("c", 0)]
    assert sorted(merged) == ["a", "b", "c"]


@pytest.mark.parametrize("rows_a_frame", [10_000, 3])
def test_changes_sort_a_history_that_arrow_cuts(spark, tmp_path, rows_a_frame):
    # times go down in the file, so that a later frame holds the earlier rows; a key, a time and a hash are missing
    rows = [("k", f"{i // 2 % 3}", i) for i in range(40, 0, -1)] + [(None, "a", 2), (None, "b", 1), ("n", None, 2), ("n", "a", 1), ("n", "a", None), ("o", None, 1)]
    data = spark.createDataFrame(rows, "key string, hash string, s long").select("key", "hash", F.timestamp_seconds("s").alias("ts"))
    data.coalesce(1).write.parquet(f"{tmp_path}/in")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_a_frame)
    try:
        stream = spark.readStream.schema(data.schema).parquet(f"{tmp_path}/in")
        got = table_queries._drained(state.changes(stream, F.col("key"), F.col("hash"), "ts", None)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows)
    k = sorted((r for r in got if r.key == "k"), key=lambda r: r.last_seen)
    assert [r.hash for r in k] == [f"{i // 2 % 3}" for i in range(1, 41)]
    assert [r.previous_hash for r in k] == [""] + [f"{i // 2 % 3}" for i in range(1, 40)]
    assert [r.status for r in k] == ["new"] + ["seen_again" if i // 2 == (i - 1) // 2 else "changed" for i in range(2, 41)]
    assert {r.first_seen for r in k} == {k[0].last_seen}
    assert sorted(r.status for r in got if r.key is None) == ["changed", "new"]
    assert sorted(r.status for r in got if r.key == "n") == ["new", "seen_again", "seen_again"] and [r.status for r in got if r.key == "o"] == ["new"]


def all_there_is_to_win(path):
    """Pages of which some get every point: no bound of the operator's may show where the SQL has none."""
    text = "AI, LLM, agent, model and training. " * 20
    connected().sql(f"SELECT i AS page_id, 'https://a.example.com/' || i AS url, '<p>{text}</p>' AS html FROM range(2000) t(i)").write_parquet(f"{path}/pages.parquet")
    return str(path)


def test_funnel_score_equals_its_sql_above_100(spark, tmp_path):
    sf = all_there_is_to_win(tmp_path)
    scored = catalog.QUERIES["funnel_score"](spark, sf)
    assert scored.where("score = 105").count() > 0
    same(spark, catalog.QUERIES["funnel_score"], catalog.ORACLE_SQL["funnel_score"], sf)


def test_funnel_itself_ends_at_100(spark):
    row = ("https://a.example.com/x", "rss", 200, 10, None, 5, "t", "AI, LLM, agent, model and training. " * 20)
    kinds = "endpoint string, connector string, http_status int, response_time_ms int, error_type string, n_articles int, first_title string, first_summary string"
    got = funnel.funnel(spark.createDataFrame([row], kinds)).first()
    assert (got.points, got.score, got.decision) == (105, 100, "pass")


def test_passed_sources_equal_their_sql_above_100(spark, tmp_path):
    sf = all_there_is_to_win(tmp_path)
    passed = catalog.QUERIES["passed_sources"](spark, sf)
    assert passed.where("eval_score = 105 AND weight = 10").count() > 0
    same(spark, catalog.QUERIES["passed_sources"], catalog.ORACLE_SQL["passed_sources"], sf)


def test_passed_sources_strip_a_page_once(spark, tmp_path):
    # a filter below the stages held 176 copies of the two patterns
    passed = catalog.QUERIES["passed_sources"](spark, all_there_is_to_win(tmp_path))
    spark.conf.set("spark.sql.maxPlanStringLength", 10_000_000)
    try:
        assert passed._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace(") == 2
    finally:
        spark.conf.unset("spark.sql.maxPlanStringLength")


def odd_pages(path):
    """Every odd page by every odd address, each with 200 ids, so that all remainders the SQL asks for come up, one missing id, and negative ones, most of them twice."""
    topic, filler = "AI, LLM, agent, model and training. ", "word " * 120
    htmls = [None, "", "<p></p>", "<p> \t</p>", "<p> </p>", topic, topic + filler, topic + "Subscribe now, click here, buy now. " + filler, topic + "http://a.b " * 60, "İnference, sİmulation, dİffusion " + filler, "<" + topic + filler, "\U0001f600" * 700]
    hosts = ["a.example.com", "amazon.com", "x.amazon.com", "buzzfeed.com", "www.buzzfeed.com", "calendly.com", "x.cloudflare.com", "user:pw@a.example.com", "user@a.example.com", "[::ffff:1.2.3.4]", "localhost", "a.example.com:80"]
    urls = [None, "", " ", " https://a.example.com/", "HTTPS://A.Example.com/x", "https:a.example.com", "git+ssh://a.example.com/", "https://a.example.com/#f\nx", *(f"https://{h}/x" for h in hosts)]
    cases = [(u, h) for u in urls for h in htmls]
    con = connected()
    con.execute("CREATE TABLE cases (k BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO cases VALUES (?, ?, ?)", [(k, *c) for k, c in enumerate(cases)])
    con.sql("SELECT k * 200 + i AS page_id, url, html FROM cases, range(200) t(i) UNION ALL SELECT NULL, url, html FROM cases UNION ALL SELECT -k * 7 - i, url, html FROM cases, range(14) t(i)").write_parquet(f"{path}/pages.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["funnel_score", "passed_sources"])
def test_scores_of_odd_pages_equal_their_sql(spark, tmp_path, name):
    same(spark, catalog.QUERIES[name], catalog.ORACLE_SQL[name], odd_pages(tmp_path))
