"""Edge rows of the pipeline's stages and of operators whose other tests leave them out."""

import random
from collections import Counter

import pytest

import corpus_pipeline as cp
from broadsheet.llm import linededup, mixing
from tests.llm.test_contracts import BODY, DOCS, LINE, WORDS


def plain_lines(docs, min_chars=20, min_docs=3):
    """Line deduplication row by row; docs is a list of (id, text)."""
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)}) for line in (t or "").split("\n")] for _, t in docs]
    found = Counter(k for (i, _), ks in zip(docs, keys, strict=True) if i is not None for k in set(ks) if len(k) >= min_chars)
    top = {}
    for (i, _), ks in zip(docs, keys, strict=True):
        for k in ks if i is not None else ():
            top[k] = max(top.get(k, i), i)
    gone = lambda i, k: i is not None and len(k) >= min_chars and found[k] >= min_docs and i < top[k]
    return [(i, "\n".join(line for line, k in zip((t or "").split("\n"), ks, strict=True) if not gone(i, k)), sum(gone(i, k) for k in ks)) for (i, t), ks in zip(docs, keys, strict=True)]


def test_line_dedup_row_by_row(spark):
    rng = random.Random(4)
    pool = [f"line number {i} that is long enough" for i in range(30)] + ["short", "", "  Line NUMBER 3 that is long enough \t"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in range(60)]
    docs += [(7, "\n".join([LINE] * 3 + pool[:5])), (7, "\n".join(pool[:5])), (None, pool[0]), (None, None), (70, "\n".join(pool * 400)), (71, LINE), (72, LINE)]
    given = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, pos string, first int")
    got = Counter((r.doc_id, r.text, r.n_dropped) for r in linededup.dedup_lines(given).collect())
    assert got == Counter(plain_lines(docs))


def test_runs_take_later_documents_up(spark):
    runs = linededup.Runs(spark)
    first = spark.createDataFrame([(i, LINE) for i in range(2)], "doc_id long, text string")
    second = spark.createDataFrame([(i, LINE) for i in (5, 6)], "doc_id long, text string")
    assert {r.n_dropped for r in linededup.dedup_lines(first, runs=runs).collect()} == {0}
    assert {r.doc_id: r.n_dropped for r in linededup.dedup_lines(second, runs=runs).collect()} == {5: 1, 6: 0}
    runs.close()


def test_mixed_words_of_many_sources(spark):
    """Targets by water-filling for more sources than weights, some of them tiny, so that several rounds fill up."""
    rng = random.Random(8)
    made = [(i, " ".join(["w"] * rng.randrange(1, 40)), "en", f"s{min(99, int(rng.expovariate(0.1))):02}", 0) for i in range(1500)]
    found = mixing.op5(spark.createDataFrame(made, DOCS)).toPandas()
    found["source"] = [made[i][3] for i in found.doc_id]
    from tests.llm.test_contracts import filled

    wanted = filled({s: sum(len(WORDS.findall(t)) for _, t, _, x, _ in made if x == s) for s in {m[3] for m in made}})
    for source, group in found.groupby("source"):
        assert group.target.iloc[0] == pytest.approx(wanted[source])
        assert abs(group.taken.sum() - wanted[source]) <= group["size"].max()


@pytest.mark.parametrize("name", [name for name, _ in cp.STAGES])
def test_stages_on_edge_rows(spark, name):
    """Empty tables, nulls in every column, repeated rows, a very long text and columns with clashing names."""
    step = dict(cp.STAGES)[name]
    kind = DOCS + ", rank string, size string, component_id string"
    assert step(spark, spark.createDataFrame([], kind), "").count() == 0
    long = " ".join(f"word{i % 977}" for i in range(60_000))  # of the letters that BODY teaches
    rows = [(1, BODY, "en", "a", 0), (1, BODY, "en", "a", 0), (2, None, None, None, None), (None, "", "en", "a", 0), (3, long, None, "b", 0), (None, None, None, None, None)]
    got = step(spark, spark.createDataFrame([(*r, "x", "y", "z") for r in rows], kind), "")
    texts = Counter(r[1] for r in rows)
    if name == "pack":
        assert got.where("piece = 0").count() == len(rows)
    else:
        assert tuple(got.columns) == cp.COLUMNS
        kept = Counter(r.text for r in got.collect())
        assert kept[long] >= 1 or name == "mix_sources"
        if name == "language_id":
            assert set(kept) == {BODY, long}
        if name in ("language_id", "line_dedup"):
            assert kept[BODY] == texts[BODY]
