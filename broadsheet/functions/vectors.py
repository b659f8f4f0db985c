"""Vector columns over ARRAY<FLOAT>, computed in double precision, and a model-free text embedding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Norms below this count as zero.
TINY = 1e-10


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector is zero."""
    lengths = norm(a) * norm(b)
    return F.when((norm(a) < TINY) | (norm(b) < TINY), F.lit(0.0)).otherwise(dot(a, b) / lengths)


def unit(a: Column) -> Column:
    bound = F.transform(F.array(norm(a)), lambda length: F.transform(a, lambda x: F.when(length < TINY, x.cast("double")).otherwise(x.cast("double") / length)))
    return F.element_at(bound, 1)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, v: s + v)


def hashed_embedding(text: Column, dimensions: int = 64) -> Column:
    """Unit vector of term counts, each word's place taken from its md5; the offline stand-in for a sentence model."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    places = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % dimensions)
    # one-element arrays bind the places and the counts, so that each is computed once a row
    counts = F.transform(F.array(places), lambda found: F.transform(F.sequence(F.lit(0), F.lit(dimensions - 1)), lambda i: F.size(F.filter(found, lambda p: p == i)).cast("double")))
    return F.element_at(F.transform(counts, lambda c: F.transform(unit(c), lambda x: x.cast("float"))), 1)


def embedding_text(title: Column, summary: Column, most: int | None = 500, joint: str = " ") -> Column:
    tail = F.coalesce(summary, F.lit(""))
    return F.concat(F.coalesce(title, F.lit("")), F.lit(joint), F.left(tail, F.lit(most)) if most else tail)
