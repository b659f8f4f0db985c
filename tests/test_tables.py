import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import clustering, curation, dedup, registry
from broadsheet.sources import connectors, readers, reports
from broadsheet.sources import tables as tb


def listed(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, first string")
    new = spark.createDataFrame([(2, "B", "z"), (3, "c", "w")], "id int, v string, first string")
    once = tb.upsert(old, new, ["id"], keep=("first",))
    assert listed(once) == [(1, "a", "x"), (2, "B", "y"), (3, "c", "w")]
    assert listed(tb.upsert(once, new, ["id"], keep=("first",))) == listed(once)


def test_store_commits_all_or_nothing(spark, tmp_path):
    store = tb.Store(spark, f"file://{tmp_path}/store")
    assert store.read("seen_urls").count() == 0
    store.commit({"a": spark.range(3), "b": spark.range(2)})
    with pytest.raises(Exception):
        store.commit({"a": spark.range(9), "b": spark.range(1).select(F.raise_error(F.lit("no")).alias("x"))})
    assert (store.read("a").count(), store.read("b").count()) == (3, 2)


def test_run_persists_twice_alike(spark, tmp_path):
    store = tb.Store(spark, f"file://{tmp_path}/store")
    sources = spark.createDataFrame([("s", "S", "rss", "e", "LLM", 1, 1.0, True, 0)], "id string, name string, connector string, endpoint string, category string, weight int, trust double, active boolean, pos int")
    articles = spark.createDataFrame([("i", "u", "t", 0), ("i", "u", "t2", 1), ("j", "", "x", 2)], "id string, url string, title string, pos int")
    events = spark.createDataFrame([("e", "T", "LLM", 0.5, 0)], "id string, title string, category string, importance double, pos int")
    links = spark.createDataFrame([("e", "u"), ("e", "u")], "event_id string, article_url string")
    for now in ("n1", "n2"):
        tb.persist_run(store, sources, articles, events, links, "2024-W01", "p", now)
    assert store.read("articles").select("url", "title", "first_seen").collect() == [("u", "t2", "n1")]
    assert store.read("event_articles").count() == store.read("report_events").count() == 1
    assert store.read("reports").select("id", "event_count", "article_count", "generated_at").collect() == [("rpt_2024W01", 1, 1, "n2")]


def test_greedy_is_not_components(spark):
    # a~b~c without a~c: b goes, c stays
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.28, 0.96]), (4, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert listed(dedup.semantic_dedup(vectors, 0.75).select("vec_id")) == [(1,), (3,), (4,)]
    assert dedup.similar_pairs(vectors, 0.75, block=1).count() == 2


def test_greedy_settles_every_row_of_a_chain(spark, monkeypatch):
    # one round settles two links; a bound on the rounds, were there one, is two here
    monkeypatch.setattr(dedup, "range", lambda n: range(min(n, 2)), raising=False)
    chain = spark.createDataFrame([(i, i + 1) for i in range(10)], "a long, b long")
    kept = dedup.greedy_kept(spark.range(11), chain)
    assert listed(kept) == [(i,) for i in range(0, 11, 2)]


def test_linkage_prefers_first_on_ties():
    m = np.array([[1.0, 0.0], [0.0, 1.0], [0.7071, 0.7071]])
    assert clustering.linkage_labels(m, 0.5).tolist() == [0, 1, 0]
    assert clustering.density_labels(np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])).tolist() == [0, 0, -1]


@pytest.mark.parametrize(("least", "reach"), [(2, 0.1), (4, 0.1), (6, 0.25)])
def test_density_clusters_of_blocks_are_those_of_a_whole_bucket(spark, least, reach):
    # blocks of a few rows, so that most neighbours meet in another task; a zero row, border rows, a dense group of copies
    random = np.random.default_rng(7)
    vectors = np.vstack([random.normal(size=(120, 3)), np.repeat([[1.0, 2.0, 3.0]], 12, axis=0), np.zeros((1, 3))])
    buckets = [None if i % 3 == 0 else "b" for i in range(len(vectors))]
    rows = spark.createDataFrame([(b, 1000 - i, v.tolist()) for i, (b, v) in enumerate(zip(buckets, vectors, strict=True))], "bucket string, id long, v array<double>")
    got = {(r.bucket, r.id): (r.cluster, r.noise) for r in clustering.density_clusters(rows, "bucket", "id", "v", least, reach, block=16).collect()}
    want = {}
    for bucket in (None, "b"):
        ids = sorted(1000 - i for i, b in enumerate(buckets) if b == bucket)
        matrix = vectors[[1000 - i for i in ids]]
        labels = clustering.density_labels(matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-10), least, reach)
        noise = labels < 0
        labels[noise] = labels.max() + 1 + np.arange(noise.sum())
        want |= {(bucket, i): (label, lone) for i, label, lone in zip(ids, labels.tolist(), noise.tolist(), strict=True)}
    assert got == want and len({n for _, n in got.values()}) == 2


def test_model_calls_fall_back(spark):
    prompts = spark.createDataFrame([(0, "good"), (1, "bad")], "batch_id long, prompt string")

    def chat(system, prompt):
        if prompt == "bad":
            raise RuntimeError
        return '[{"event_index": 0, "importance": 2.0}]'

    rows = curation.replies(curation.ask(prompts, chat, "s"))
    assert [(r.batch_id, r.event_index, r.importance) for r in rows.collect()] == [(0, 0, 2.0)]


def test_feeds_and_connectors(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>A  b</title><link>u1</link><description>&lt;p&gt;x&lt;/p&gt;</description><pubDate>Tue, 30 Jan 2024 00:00:00 GMT</pubDate></item><item><title>old</title><link>u2</link><pubDate>Tue, 02 Jan 2024 00:00:00 GMT</pubDate></item><item><title>undated</title><link>u3</link></item></channel></rss>")
    got = readers.rss(spark, str(tmp_path / "f.xml"), F.lit("2024-01-31").cast("timestamp"))
    assert listed(got.select("url", "title", "summary").fillna("")) == [("u1", "A b", "x"), ("u3", "undated", "")]
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "a.jsonl").write_text('{"url": "u", "title": "t"}\n')
    connectors.register(spark)
    assert spark.read.format("landed_articles").option("path", str(tmp_path / "l")).load().select("url").collect() == [("u",)]
    assert connectors.connectors(spark).first()["name"] == "rss"


def test_report_pages(spark, tmp_path):
    events = spark.createDataFrame([("A <b>", "s", "LLM", 0.625, "x, y, x")], "title string, summary string, category string, importance double, source_names string")
    assert reports.render("2024-W01", events, str(tmp_path / "r")) == ["index.html", "llm.html"]
    assert "A &lt;b&gt;" in (tmp_path / "r" / "llm.html").read_text()


def test_aliases(spark):
    rows = spark.createDataFrame([("rss", None)], "type string, connector string")
    assert registry.aliased(rows, {"connector": "type"}).first().asDict() == {"type": "rss", "connector": "rss"}


def test_numbers_are_consecutive(spark):
    from broadsheet.plans.numbering import numbered

    rows = numbered(spark.range(1000).repartition(7), ["id"], "n", 1)
    assert rows.where("n <> id + 1").count() == 0 and rows.count() == 1000


def test_batches_of_prompts(spark):
    got = curation.batches(spark.range(5), "id", 2).orderBy("id").select("batch_id", "event_index").collect()
    assert [tuple(r) for r in got] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]
