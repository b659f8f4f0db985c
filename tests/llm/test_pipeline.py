"""The pipeline on a small corpus, stage by stage, against plain versions."""

import base64
import random
import re
from collections import Counter

import pytest

import corpus_pipeline as cp
from tests.llm.test_contracts import BODY, DOCS, LINE, WORDS, packed_as_wanted


@pytest.fixture(scope="module")
def docs(spark):
    near = BODY.replace("word59", "other")
    texts = {0: BODY, 1: BODY, 2: near, 3: "The quick brown fox jumps over", 4: "Der schnelle braune Fuchs springt", 5: "12 34", 6: None, 7: f"{LINE}\nfirst own words here", 8: f"{LINE}\nsecond own words there", 9: f"{LINE}\nthird own words now"}
    return spark.createDataFrame([(i, t, "de" if i == 4 else "en", "ab"[i % 2], 0) for i, t in texts.items()], DOCS)


def test_stages(spark, docs):
    order = [name for name, _ in cp.STAGES]
    assert order == ["language_id", "line_dedup", "near_dedup", "mix_sources", "pack"]
    step = dict(cp.STAGES)
    one = step["language_id"](spark, docs, "").cache()
    assert sorted(r.doc_id for r in one.collect()) == [0, 1, 2, 3, 4, 7, 8, 9]
    two = step["line_dedup"](spark, one, "").cache()
    assert {r.doc_id: r.text for r in two.collect()} | {7: "first own words here", 8: "second own words there", 9: f"{LINE}\nthird own words now"} == {r.doc_id: r.text for r in two.collect()}
    three = step["near_dedup"](spark, two, "").cache()
    assert sorted(r.doc_id for r in three.collect()) == [0, 3, 4, 7, 8, 9]
    four = step["mix_sources"](spark, three, "").cache()
    texts = {r.doc_id: r.text for r in three.collect()}
    copies = Counter(r.doc_id for r in four.collect())
    assert set(copies) <= set(texts) and max(copies.values()) <= 2
    assert all(r.text == texts[r.doc_id] for r in four.collect())
    for stage in (one, two, three, four):
        assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    used, bound = packed_as_wanted(step["pack"](spark, four, "").toPandas(), [(r.doc_id, r.text) for r in four.collect()])
    assert used == bound


def test_run_takes_the_words_that_the_targets_ask(spark):
    found = cp.run(spark, "/root/testdata/sf0.001").toPandas()
    assert found.groupby("sequence_id").length.sum().max() <= 2048
    assert len(found) > 100
    assert re.match(WORDS, "a")


def test_near_copies_from_four_fifths_on_go(spark):
    words = [f"v{i}" for i in range(104)]
    texts = {}
    for i, (at, n) in {0: (0, 0), 1: (10, 6), 2: (40, 8)}.items():  # 100 shingles; n replaced words in a row change n + 4 of them
        texts[i] = " ".join([*words[:at], *(f"n{i}x{j}" for j in range(n)), *words[at + n :]])
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(100)} for i, t in texts.items()}
    alike = {i: len(sets[0] & sets[i]) / len(sets[0] | sets[i]) for i in (1, 2)}
    assert 0.8 <= alike[1] < 0.85 and alike[2] < 0.8
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in texts.items()], DOCS)
    assert sorted(r.doc_id for r in cp.drop_near_duplicates(spark, docs, "").collect()) == [0, 2]


def test_lettered_junk_and_unlearned_languages_go(spark):
    rng = random.Random(1)
    junk = [
        " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 10))) for _ in range(60)), base64.b64encode(rng.randbytes(900)).decode(), " ".join(f"{rng.getrandbits(256):064x}" for _ in range(9)),
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
    ]
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*cp.COLUMNS)
    added = spark.createDataFrame([(-1 - i, t, None, "a", len(t)) for i, t in enumerate(junk)], DOCS)
    kept = [r.doc_id for r in cp.identify_language(spark, given.unionByName(added), "").select("doc_id").collect()]
    assert not [i for i in kept if i < 0]
    assert len(kept) > 0.99 * given.count()


def test_null_and_repeated_ids_are_whole_rows(spark):
    other = " ".join(f"unlike{i}" for i in range(60))
    given = [(1, BODY, "en", "a", 0), (1, BODY, "en", "a", 0), (2, BODY, "en", "a", 0), (2, other, "en", "a", 0), (None, BODY, "en", "a", 0), (None, "of its own", "en", "a", 0)]
    near = sorted((r.doc_id or 9, r.text) for r in cp.drop_near_duplicates(spark, spark.createDataFrame(given, DOCS), "").collect())
    assert near == sorted([(1, BODY), (2, other), (9, "of its own")])
    # one source: its target is 1.5 times its words, two copies a row at most
    alike = [(5, BODY, "en", "a", 0)] * 2 + [(None, f"{BODY} {i}", "en", "a", 0) for i in range(6)]
    got = Counter((r.doc_id, r.text) for r in cp.mix_sources(spark, spark.createDataFrame(alike, DOCS), "").collect())
    assert got[5, BODY] <= 4 and all(got[None, f"{BODY} {i}"] in (1, 2) for i in range(6))
    assert 11 <= sum(got.values()) <= 13
