"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1 drawn from its code point. A trigram's vector binds
(multiplies) its letters' vectors, each rotated by its place; a text's vector bundles (adds) those of its
trigrams, with one space for every run of other characters and at both ends. A trigram that a text has n times counts
1 + floor(log2(n)). A language's prototype bundles the distinct trigrams of all its labelled texts, so that texts that
repeat themselves do not drown the others. Texts are compared with prototypes by cosine, after the prototypes'
mean direction, which all languages share, is taken out of both.

Nulls: a null text, or one without a letter, is `und` with score 0; rows with a null language train nothing.
Without any labelled letter every text is `und`. Ties go to the language that sorts first. Texts are
read whole; repeated rows count each time; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import held, slices

DIMENSIONS, NGRAM, SEED = 1024, 3, 20
#: More learned languages than this raise an error; prototypes are sent to every task, DIMENSIONS doubles each.
MOST_LANGUAGES = 1024
UNDETERMINED = "und"
#: Scores below this are no sign of a language: 3.2 standard errors of the cosine of unrelated vectors.
FLOOR = 3.2 / DIMENSIONS**0.5
#: Trigram vectors that a worker keeps in one table, one byte a dimension; a full table is begun anew.
_KEPT = 1 << 15


class Encoder:
    """Turns texts into trigram counts, and trigrams into vectors. A worker keeps one across its tasks."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED) -> None:
        self.dimensions, self.seed = dimensions, seed
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        self.letters: dict[int, np.ndarray] = {}
        self.keys, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.vectors = np.empty((_KEPT, dimensions), np.int8)

    def trigrams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, trigram key, count), ordered by document; documents without a letter have none."""
        parts, owners = [], []
        for i, text in enumerate(texts):
            codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            is_letter = self.letter[codes]
            if not is_letter.any():
                continue
            keep = is_letter.copy()
            keep[1:] |= is_letter[:-1]
            codes = np.where(is_letter, codes, 0)[keep]  # begins with a letter; one 0 after each run of letters
            row = np.zeros(len(codes) + (2 if codes[-1] else 1), np.uint64)
            row[1 : len(codes) + 1] = codes
            keys = row[:-2] << np.uint64(42) | row[1:-1] << np.uint64(21) | row[2:]
            found, counts = np.unique(keys, return_counts=True)
            parts.append((found, counts))
            owners.append(np.full(len(found), i))
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        return np.concatenate(owners), np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])

    def _of_letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, np.int8) * np.int8(2) - np.int8(1)
        return self.letters[code]

    def _made(self, key: int) -> np.ndarray:
        mask = (1 << 21) - 1
        return np.roll(self._of_letter(key >> 42), 2) * np.roll(self._of_letter(key >> 21 & mask), 1) * self._of_letter(key & mask)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of at most _KEPT distinct, sorted trigram keys."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        if not known.all():
            fresh = keys[~known]
            if len(self.keys) + len(fresh) > _KEPT:
                self.keys, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)
                fresh = keys
            free = np.arange(len(self.keys), len(self.keys) + len(fresh))
            for place, key in zip(free, map(int, fresh), strict=True):
                self.vectors[place] = self._made(key)
            merged = np.concatenate([self.keys, fresh])
            order = np.argsort(merged)
            self.keys, self.places = merged[order], np.concatenate([self.places, free])[order]
            at = np.searchsorted(self.keys, keys)
        return self.vectors[self.places[at]]

    def bundle(self, owners: np.ndarray, keys: np.ndarray, counts: np.ndarray, rows: int, block: int = 4096) -> np.ndarray:
        """Sums of counts times vectors for each of rows owners; whole numbers, exact in the type chosen."""
        distinct, place = np.unique(keys, return_inverse=True)
        exact = np.float32 if counts.sum() < 1 << 24 else np.float64
        out = np.zeros((rows, self.dimensions))
        for start in range(0, len(distinct), block):
            part = distinct[start : start + block]
            inside = (place >= start) & (place < start + block)
            weights = np.zeros((rows, len(part)), exact)
            weights[owners[inside], place[inside] - start] = counts[inside]
            out += weights @ self.of(part).astype(exact)
        return out


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """A prototype for each language of all labelled texts.

    Every task adds up its own texts; the partial sums, one number for each language, dimension and
    task, are added by a group-by. The driver gets languages times dimensions numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("profiles", dimensions, seed), lambda: Encoder(dimensions, seed))
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text", 1 << 20, 256):
            langs = np.array(batch.column("lang").to_pylist(), object)
            owners, keys, _ = encoder.trigrams(batch.column("text").to_pylist())
            for name in dict.fromkeys(langs[owners]):
                own = langs[owners] == name
                distinct, texts = np.unique(keys[own], return_counts=True)
                added = encoder.bundle(np.zeros(len(distinct), np.int64), distinct, texts, 1)[0]
                sums[name] = sums.get(name, 0) + np.rint(added).astype(np.int64)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(total)], names=["lang", "dim", "value"])

    known = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    sums = known.mapInArrow(run, "lang string, dim int, value long").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    rows = sums.limit(MOST_LANGUAGES * dimensions + 1).collect()
    if len(rows) > MOST_LANGUAGES * dimensions:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found: dict[str, np.ndarray] = {}
    for lang, dim, value in rows:
        found.setdefault(lang, np.zeros(dimensions))[dim] = value
    return {k: found[k] for k in sorted(found) if found[k].any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: dict[str, str], text_col: str = "text", dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Adds lang_pred and score to the columns in keep (name to type); reads the text alone."""
    names, langs = list(keep), list(prototypes)

    def unit(rows: np.ndarray) -> np.ndarray:
        return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)

    profiles = unit(np.stack([prototypes[k] for k in langs])) if langs else np.zeros((0, dimensions))
    shared = profiles.mean(axis=0) if len(langs) > 1 else np.zeros(dimensions)
    shared = shared / max(np.linalg.norm(shared), 1e-12)
    profiles = unit(profiles - np.outer(profiles @ shared, shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("profiles", dimensions, seed), lambda: Encoder(dimensions, seed))
        for batch in slices(batches, "text", 1 << 20, 256):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            owners, keys, counts = encoder.trigrams(texts)
            bundles = unit(encoder.bundle(owners, keys, np.frexp(counts)[1], len(texts)))  # the exponent of n is 1 + floor(log2(n))
            cosines = np.round(unit(bundles - np.outer(bundles @ shared, shared)) @ profiles.T, 9)
            lettered = np.zeros(len(texts), bool)
            lettered[owners] = bool(langs)
            best = cosines.argmax(axis=1) if langs else np.zeros(len(texts), int)
            pred = [langs[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)]
            score = np.where(lettered, np.clip(cosines.max(axis=1), 0, 1), 0.0) if langs else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(pred, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    inputs = [F.col(n) for n in names] + [F.col(text_col).alias("text")] * ("text" not in names)
    return docs.select(*inputs).mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in keep.items()), "lang_pred string, score double"]))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1


def op2(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", "text", "lang", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
    prototypes = train(rows.where("NOT held_out"))
    return predict(rows.select("doc_id", "held_out", "text"), prototypes, {"doc_id": "long", "held_out": "boolean"})
