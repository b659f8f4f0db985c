"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree.

A source's target over its size is the number of copies each of its documents takes on average. The whole part
is taken at once; the fraction is rounded by pivots: two fractional documents exchange mass (size times
fraction, so the words taken do not change) at random, with the chances that leave every expectation as it
is, until one of them is whole. Leaves of about LEAF documents are reduced first, from large to small;
each leaves at most one fractional document, and these are reduced LEAF at a time, level by level, until each
source has one, which is rounded to the nearer number. Random numbers are hashes of the pair of ids, so reruns
agree. DataFrame functions only.

Nulls: a null text has size 0; null sources are one source, which sorts last. Empty texts take the copies
their fraction gives and no words. Repeated rows are rounded together and share their copies evenly, so none
takes more than the cap. Ties in size go by id. An empty table gives an empty result. A hot source only has more
leaves than others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.numbering import numbered
from .shared import WORD, stage

WEIGHTS, SHARE, CAP, LEAF, SEED = (3.0, 1.0, 2.0), 1.5, 2.0, 64, 5
#: A fraction this near to a whole number counts as whole.
_EPS = 1e-9

_PIECE = "struct<id: bigint, size: double, p: double, whole: bigint, rows: bigint>"


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, rank, source_size, n_docs, target) for each source of (source, size): water-filling below the caps.

    Sources are ordered by code point, null last, and take the weights in turn. Those whose part of what is left lies above
    their cap are filled to it and what they cannot take is dealt out again, until none is above. Each round is one
    aggregate of a number for each weight; sources are numbered by ranges, so that many of them meet in no one task.
    """
    sources = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    ranked = numbered(sources.withColumn("_none", F.col("source").isNull()), ["_none", "source"], "rank").drop("_none")
    turn = (F.col("rank") % len(weights)).cast("int")
    full = stage(ranked.withColumn("turn", turn).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1)).withColumn("most", F.col("source_size") * F.lit(float(cap))), "sources")
    total, level, closed = None, None, -1
    while True:
        over = F.lit(False) if level is None else F.lit(level) * F.col("weight") > F.col("most")
        found = full.groupBy("turn").agg(F.sum("source_size").alias("all"), F.sum(F.when(over, F.col("source_size")).otherwise(0)).alias("filled"), F.count(F.when(over, 1)).alias("closed"), F.count(F.lit(1)).alias("n")).collect()
        total = sum(r["all"] for r in found) * float(share)
        open_weight = sum((r["n"] - r["closed"]) * float(weights[r["turn"]]) for r in found)
        if sum(r["closed"] for r in found) == closed or not open_weight:
            break
        closed = sum(r["closed"] for r in found)
        level = (total - float(cap) * sum(r["filled"] for r in found)) / open_weight
    target = F.least(F.col("most"), F.lit(level) * F.col("weight")) if level is not None and open_weight else F.col("most")
    return full.select("source", "rank", "source_size", "n_docs", target.alias("target"))


def _uniform(*keys: str) -> str:
    return f"(pmod(xxhash64({', '.join(keys)}), 9007199254740992L) / 9007199254740992D)"


def _reduced(pieces: str, seed: int) -> str:
    """SQL that pivots an array of pieces: struct(rest: the fractional piece or null, done: pieces with p 0 or 1)."""
    whole = f"x -> x.p <= {_EPS}D OR x.p >= 1D - {_EPS}D"
    settle = "x -> named_struct('id', x.id, 'size', x.size, 'p', round(x.p), 'whole', x.whole, 'rows', x.rows)"
    start = f"named_struct('rest', CAST(NULL AS {_PIECE}), 'done', CAST(array() AS array<{_PIECE}>))"
    # up: what the rest can take from e; down: what it can give
    moved = f"""
      transform(array(named_struct('a', acc.rest, 'e', e,
          'up', least(acc.rest.size * (1D - acc.rest.p), e.size * e.p),
          'down', least(acc.rest.size * acc.rest.p, e.size * (1D - e.p)))),
        m -> named_struct('a', m.a, 'e', m.e, 'by',
          if({_uniform('m.a.id', 'm.e.id', f'{seed}L')} * (m.up + m.down) < m.down, m.up, -m.down)))[0]"""
    pair = f"""
      transform(array({moved}), m -> array(
        named_struct('id', m.a.id, 'size', m.a.size, 'p', m.a.p + m.by / m.a.size, 'whole', m.a.whole, 'rows', m.a.rows),
        named_struct('id', m.e.id, 'size', m.e.size, 'p', m.e.p - m.by / m.e.size, 'whole', m.e.whole, 'rows', m.e.rows)))[0]"""
    step = f"""
      if(acc.rest IS NULL, named_struct('rest', e, 'done', acc.done),
        transform(array({pair}), q -> named_struct(
          'rest', get(filter(q, x -> NOT (x.p <= {_EPS}D OR x.p >= 1D - {_EPS}D)), 0),
          'done', concat(acc.done, transform(filter(q, {whole}), {settle}))))[0])"""
    ordered = f"array_sort({pieces}, (l, r) -> CASE WHEN l.size > r.size THEN -1 WHEN l.size < r.size THEN 1 WHEN l.id < r.id THEN -1 WHEN l.id > r.id THEN 1 ELSE 0 END)"
    return f"aggregate({ordered}, {start}, (acc, e) -> {step})"


def mix(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """(id, size, source_size, target, copies) for every row; copies is at most ceil(cap)."""
    sized = stage(docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), F.coalesce(size, F.lit(0)).cast("long").alias("size")), "sizes")
    table = stage(targets(sized, weights, share, cap), "targets")

    units = stage(sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "units")
    joined = units.join(table, units.source.eqNullSafe(table.source)).drop(table.source)
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)) * F.col("rows")
    parts = joined.withColumn("wanted", wanted).withColumn("whole", F.floor(F.col("wanted") + F.lit(_EPS)).cast("long")).withColumn("p", F.greatest(F.lit(0.0), F.col("wanted") - F.col("whole")))
    leaves = F.ceil(F.col("n_docs") / F.lit(LEAF)).cast("long")
    piece = F.expr(f"CAST(named_struct('id', id, 'size', CAST(size AS DOUBLE), 'p', p, 'whole', whole, 'rows', rows) AS {_PIECE})")
    nodes = parts.select("rank", F.when(F.col("size") > 0, F.pmod(F.xxhash64("id", F.lit(seed)), leaves)).alias("node"), piece.alias("piece"))
    nodes = stage(nodes, "pieces")

    loose = (F.col("node").isNull()) | (F.col("piece.p") <= _EPS)
    settled = [nodes.where(loose).select("rank", F.expr(f"named_struct('id', piece.id, 'size', piece.size, 'p', if({_uniform('piece.id', f'{seed}L')} < piece.p, 1D, 0D), 'whole', piece.whole, 'rows', piece.rows)").alias("piece"))]
    level = nodes.where(~loose)
    depth, most = 0, -(-(table.agg(F.max("n_docs")).first()[0] or 1) // LEAF)
    while True:
        reduced = stage(level.groupBy("rank", "node").agg(F.expr(_reduced("collect_list(piece)", seed)).alias("r")), f"level{depth}")
        settled.append(reduced.select("rank", F.explode("r.done").alias("piece")))
        rest = reduced.where("r.rest IS NOT NULL").select("rank", "node", F.col("r.rest").alias("piece"))
        if most <= 1:
            break
        level, most, depth = rest.withColumn("node", F.floor(F.col("node") / LEAF)), -(-most // LEAF), depth + 1
    settled.append(rest.select("rank", F.expr("named_struct('id', piece.id, 'size', piece.size, 'p', round(piece.p), 'whole', piece.whole, 'rows', piece.rows)").alias("piece")))

    done = settled[0]
    for more in settled[1:]:
        done = done.unionByName(more)
    every = done.select("rank", "piece.*").withColumn("all", F.col("whole") + F.col("p").cast("long"))
    rows = every.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))
    copies = F.floor(F.col("all") / F.col("rows")) + (F.col("i") < F.col("all") % F.col("rows")).cast("long")
    return rows.join(table.drop("source", "n_docs"), "rank").select(F.col("id").alias(id_col), F.col("size").cast("long").alias("size"), "source_size", "target", copies.cast("int").alias("copies"))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def op5(docs: DataFrame) -> DataFrame:
    mixed = mix(docs, word_count(F.col("text")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
