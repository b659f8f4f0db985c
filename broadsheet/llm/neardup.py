"""Near-duplicate groups by b-bit MinHash, every link confirmed on full shingle sets.

1. Each text becomes the set of its distinct 5-word shingles (64-bit hashes), ROWS minima for each band, a key for
   each band and a signature of the minima's low BITS bits, packed into 64-bit words.
2. Texts with equal sets are one class, named by its smallest id; only classes go on.
3. Classes that share a band key are candidates. Within a band bucket the similarity is estimated by counting equal
   fields of the packed signatures and taking out the 2**-BITS that agree by chance; pairs estimated within
   MARGIN standard errors of the threshold join a coarse group, written as a spanning forest per bucket.
4. Within a coarse group all sets are compared exactly and the links, again as a spanning forest, give the
   components.

Buckets and coarse groups of any size are cut into blocks of BLOCK classes, so that no task holds more than two blocks,
nothing is capped and no pair is written out that a forest does not need. First each block is compared by itself; what
is linked is contracted, and one class of each part goes on to the next round, while rounds halve their number. Where
parts are left, their classes are compared across parts, block by block, and among classes of small parts only blocks of
like set sizes, as linked sets differ in size by less than the threshold.
The threshold is a parameter, and the number of bands follows from it: 24 for 0.85, 35 for 0.8. A link right at the
threshold is missed by the bands with a chance of (1 - threshold**ROWS)**bands, below one in a million, and by the
estimate with one of about three in a million.

Nulls: null, empty and blank texts have an empty set, no links and themselves as component. Texts of fewer than
five words are one shingle, the whole sequence. Repeated rows are in one class; an id that repeats with other texts is one node.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .shared import held, slices, stage

SHINGLE, ROWS, BITS, SEED = 5, 5, 4, 11
#: Links need 100 * shared >= percent * united; this is op9's.
PERCENT = 85
#: The bands may miss a link at the threshold with this chance.
MISSED = 1e-6
MARGIN, BLOCK = 4.5, 64

_FIELDS = np.uint64(int("1" * (64 // BITS), 1 << BITS))


def bands_for(percent: int) -> int:
    """The fewest bands of ROWS minima that miss a link of this similarity with a chance of at most MISSED."""
    return math.ceil(math.log(MISSED) / math.log1p(-((percent / 100) ** ROWS))) if percent < 100 else 1


# ---- shingles and signatures ---------------------------------------------------------------------
def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Word to 64-bit hash, for as many words as a worker may keep."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 64:
            self[word] = value
        return value


def shingles(text: bytes, words: Words, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles. bytes.split() splits at space and bytes 9 to 13, lower() lowers A-Z."""
    hashes = np.fromiter(map(words.__getitem__, found := text.lower().split()), np.uint64, len(found))
    if not len(hashes):
        return hashes
    span = min(size, len(hashes))
    total = np.full(len(hashes) - span + 1, span, np.uint64)
    for i in range(span):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(hashes) - span + 1 + i])
    return np.unique(total)


class Signer:
    """Minima of ROWS multiplicative permutations of 32-bit shingle hashes for each band that percent asks."""

    def __init__(self, seed: int = SEED, percent: int = PERCENT) -> None:
        rng = np.random.default_rng(seed)
        self.n_bands = bands_for(percent)
        self.hashes = self.n_bands * ROWS
        self.factor = rng.integers(0, 1 << 31, self.hashes, np.uint32)[:, None] * np.uint32(2) + np.uint32(1)
        self.offset = rng.integers(0, 1 << 32, self.hashes, np.uint32)[:, None]
        self.shift = (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))[None, :]
        self.salt = _mix(np.arange(1, self.n_bands + 1, dtype=np.uint64))

    def minima(self, found: np.ndarray, block: int = 4096) -> np.ndarray:
        low = (found >> np.uint64(32)).astype(np.uint32)
        out = np.full(self.hashes, 0xFFFFFFFF, np.uint32)
        for start in range(0, len(low), block):
            np.minimum(out, (low[start : start + block] * self.factor + self.offset).min(axis=1), out=out)
        return out

    def bands(self, minima: np.ndarray) -> np.ndarray:
        """A 64-bit key for each band, the band's number mixed in."""
        total = self.salt.copy()
        for column in minima.reshape(self.n_bands, ROWS).T.astype(np.uint64):
            total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + column)
        return total

    def packed(self, minima: np.ndarray) -> np.ndarray:
        words = (self.hashes * BITS + 63) // 64
        fields = np.zeros(words * (64 // BITS), np.uint64)
        fields[: self.hashes] = minima & np.uint32((1 << BITS) - 1)
        return np.bitwise_or.reduce(fields.reshape(words, -1) << self.shift, axis=1)


def estimate(left: np.ndarray, right: np.ndarray, hashes: int = bands_for(PERCENT) * ROWS) -> np.ndarray:
    """Similarity of packed signatures (..., words): equal fields by bit counts, corrected for chance agreement."""
    differ = left ^ right
    step = 1
    while step < BITS:
        differ = differ | differ >> np.uint64(step)
        step *= 2
    unequal = np.bitwise_count(differ & _FIELDS).sum(axis=-1, dtype=np.int64)
    chance = 2.0**-BITS
    return (1 - unequal / hashes - chance) / (1 - chance)


def floor_of(similarity: float, hashes: int, margin: float = MARGIN) -> float:
    """The lowest estimate that a pair of this similarity gives but for `margin` standard errors."""
    chance = 2.0**-BITS
    agree = chance + (1 - chance) * similarity
    return similarity - margin * (agree * (1 - agree) / hashes) ** 0.5 / (1 - chance)


# ---- comparing the rows of a key, block by block -------------------------------------------------
def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    n = len(linked)
    label, edges = np.full(n, -1), []
    for root in range(n):
        if label[root] >= 0:
            continue
        label[root], front = root, [root]
        while front:
            at = front.pop()
            fresh = np.flatnonzero(linked[at] & (label < 0))
            label[fresh] = root
            edges += [(at, int(x)) for x in fresh]
            front += fresh.tolist()
    return edges


def compared(dealt: DataFrame, payload: str, kernel: Callable[[list], np.ndarray]) -> DataFrame:
    """Edges (wide, a, b), a spanning forest of the links within each group (key, i, j) of dealt (key, i, j, wide, id, payload)."""
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    names = ["wide", "a", "b"]

    def flush(group: list[tuple], wide: bool) -> list[tuple[bool, int, int]]:
        if len(group) < 2:
            return []
        ids = [g[0] for g in group]
        return [(wide, ids[i], ids[j]) for i, j in forest(kernel([g[1] for g in group]))]

    def batch_of(edges: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[0] for e in edges], pa.bool_()), *(pa.array([e[k] for e in edges], pa.int64()) for k in (1, 2))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, wide, group, edges = None, False, [], []
        for batch in batches:
            heads = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "i", "j", "wide")], axis=1)
            ids = batch.column("id").to_pylist()
            values = batch.column(payload)
            cuts = np.flatnonzero((heads[1:] != heads[:-1]).any(axis=1)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                if begin == end:
                    continue
                head = tuple(heads[begin].tolist())
                if head != at:
                    edges += flush(group, wide)
                    at, wide, group = head, bool(head[3]), []
                group += [(ids[x], np.frombuffer(values[x].as_py(), np.uint64)) for x in range(begin, end)]
            if len(edges) > 1 << 16:
                yield batch_of(edges)
                edges = []
        yield batch_of(edges + flush(group, wide))

    return ordered.select("key", "i", "j", "wide", "id", payload).mapInArrow(run, "wide boolean, a long, b long")


def _own(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(7)), blocks).cast("int")


def _across(units: DataFrame, block: int) -> DataFrame:
    """(key, kind, unit, first, blocks, others): where each unit's blocks lie, and the blocks that its rows are compared with.

    Units (key, kind, unit) with their number of rows are large parts (kind 0) or, of all small parts, the classes of one
    size step (kind 1). Parts are compared with all but themselves, steps with all parts, themselves and the steps next to them.
    """
    every, ordered = Window.partitionBy("key"), Window.partitionBy("key").orderBy("kind", "unit")
    near = Window.partitionBy("key", "kind").orderBy("unit").rangeBetween(-1, 1)
    between = lambda low, end: F.when(low < end, F.sequence(low, end - 1)).otherwise(F.array().cast("array<int>"))
    zero, first, end = F.lit(0), F.col("first"), F.col("first") + F.col("blocks")
    laid = units.withColumn("blocks", F.ceil(F.col("rows") / F.lit(block)).cast("int")).withColumn("first", (F.sum("blocks").over(ordered) - F.col("blocks")).cast("int"))
    laid = (
        laid.withColumn("all", F.sum("blocks").over(every).cast("int"))
        .withColumn("parts", F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("blocks"))).over(every), zero).cast("int"))
        .withColumn("low", F.min("first").over(near))
        .withColumn("high", F.max(end).over(near))
    )
    others = F.when(F.col("kind") == 0, F.concat(between(zero, first), between(end, F.col("all")))).otherwise(F.concat(between(zero, F.col("parts")), between(F.col("low"), F.col("high"))))
    return laid.select("key", "kind", "unit", "first", "blocks", others.alias("others"))


def blocked(rows: DataFrame, make: Callable[[DataFrame], DataFrame], payload: str, count: Column, kernel: Callable[[list], np.ndarray], percent: int, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) whose components are those of all links among rows of one key.

    make turns rows (key, size, id, ...), size being the key's number of rows, into (key, size, id, payload, ...); count tells
    the set's size from these; kernel gets the payloads of at most about two blocks and tells which are linked.
    """
    alone = make(rows).select("key", "id", payload, _own(F.ceil(F.col("size") / F.lit(block))).alias("i"), (F.col("size") > block).alias("wide"))
    first = stage(compared(alone.withColumn("j", F.col("i")), payload, kernel), "links")
    found, linked_ = first.select("a", "b"), first.where("wide").select("a", "b")
    if rows.where(F.col("size") > block).isEmpty():
        return found
    # a set and one of the next step but one differ in size by more than the threshold
    step = F.floor(F.log(count.cast("double")) / F.lit(-math.log(percent / 100)) + F.lit(1e-9)) if percent < 100 else count
    wide = stage(make(rows.where(F.col("size") > block)).select("key", "id", payload, step.cast("long").alias("step")), "wide")
    before = None
    while True:
        parts = connected_components(linked_)
        at = wide.select("key", "id", "step").join(parts, wide.id == parts.node, "left").select("key", "id", "step", F.coalesce("component", "id").alias("part"))
        at = stage(at, "parts")
        sizes = stage(at.groupBy("key", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("id")), "part-sizes")
        several = stage(sizes.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "several")
        left = several.agg(F.sum("size")).first()[0] or 0
        if not left:
            return found
        if before is not None and 2 * left > before:
            break
        before = left
        reps = sizes.select("key", "id").join(several, "key")
        alone = wide.select("key", "id", payload).join(reps, ["key", "id"]).select("key", "id", payload, _own(F.ceil(F.col("size") / F.lit(block))).alias("i"), F.lit(True).alias("wide"))
        more = stage(compared(alone.withColumn("j", F.col("i")), payload, kernel), "links").select("a", "b")
        found, linked_ = found.unionByName(more), more.unionByName(parts.select(F.col("node").alias("a"), F.col("component").alias("b")))
    large = F.col("rows") >= block
    kind, unit = F.when(large, 0).otherwise(1), F.when(large, F.col("part")).otherwise(F.col("step"))
    dealt = at.join(sizes.select("key", "part", "rows"), ["key", "part"]).join(several.select("key"), "key", "left_semi").select("key", "id", kind.alias("kind"), unit.alias("unit"))
    dealt = stage(dealt, "units")
    laid = stage(_across(dealt.groupBy("key", "kind", "unit").agg(F.count(F.lit(1)).alias("rows")), block), "layout")
    placed = dealt.join(laid, ["key", "kind", "unit"]).select("key", "id", (F.col("first") + _own(F.col("blocks"))).alias("own"), F.explode("others").alias("other"))
    paired = placed.join(wide.select("key", "id", payload), ["key", "id"])
    last = paired.select("key", "id", payload, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.lit(True).alias("wide"))
    return found.unionByName(stage(compared(last, payload, kernel), "links").select("a", "b"))


def similar(signatures: list[np.ndarray], percent: int) -> np.ndarray:
    stacked, hashes = np.stack(signatures), bands_for(percent) * ROWS
    least = floor_of(percent / 100, hashes)
    return np.stack([estimate(one, stacked, hashes) for one in stacked]) >= least


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sorted sets reach the threshold, exactly."""
    sizes = np.array([len(s) for s in sets], np.int64)
    n = len(sets)
    shared = np.zeros((n, n), np.int64)
    if n == 2:
        shared[0, 1] = shared[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    else:
        values, place = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(n), sizes)
        often = np.bincount(place, minlength=len(values)) > 1
        rank = np.cumsum(often) - 1
        keep = often[place]
        place, owner = rank[place[keep]], owner[keep]
        for start in range(0, int(often.sum()), 8192):
            inside = (place >= start) & (place < start + 8192)
            table = np.zeros((n, 8192), np.float32)
            table[owner[inside], place[inside] - start] = 1
            shared += np.rint(table @ table.T).astype(np.int64)
    united = sizes[:, None] + sizes[None, :] - shared
    out = 100 * shared >= percent * united
    np.fill_diagonal(out, False)
    return out


# ---- the operator --------------------------------------------------------------------------------
def _text(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, same, signature, bands): same is a 128-bit digest of the set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, signer = held(("words",), Words), Signer(percent=percent)
        for batch in slices(batches, "text"):
            counts, same, packed, bands = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = shingles(text, words)
                counts.append(len(found))
                if not len(found):
                    same.append(None), packed.append(None), bands.append(None)
                    continue
                minima = signer.minima(found)
                same.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                packed.append(signer.packed(minima).tobytes())
                bands.append(signer.bands(minima).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(same, pa.binary()), pa.array(packed, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["id", "n_shingles", "same", "signature", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), _text(docs, text_col).alias("text")).mapInArrow(run, "id long, n_shingles long, same binary, signature binary, bands array<long>")


def shingle_sets(docs: DataFrame) -> DataFrame:
    """(key, size, id, shingles) of (key, size, id, text): the sorted set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = held(("words",), Words)
        for batch in slices(batches, "text"):
            sets = [shingles(t, words).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("size"), batch.column("id"), pa.array(sets, pa.binary())], names=["key", "size", "id", "shingles"])

    return docs.select("key", "size", "id", "text").mapInArrow(run, "key long, size long, id long, shingles binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) for every row; texts whose sets reach percent are linked."""
    signed = stage(signatures(docs, id_col, text_col, percent), "signatures")
    classes = stage(signed.where("same IS NOT NULL").groupBy("same").agg(F.min("id").alias("rep")), "classes")
    named = signed.select("id", "n_shingles", "same").join(classes, "same", "left")
    firsts = classes.select(F.col("rep").alias("id"), F.col("same").alias("same_"))
    reps = signed.join(firsts, (signed.id == firsts.id) & (signed.same == firsts.same_), "left_semi").dropDuplicates(["id", "same"])
    reps = stage(reps.select("id", F.col("n_shingles").alias("n"), "signature", "bands"), "reps")

    keyed = reps.select("id", F.explode("bands").alias("key"))
    buckets = stage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
    crowded = stage(keyed.join(buckets, "key"), "crowded")
    with_signature = lambda rows: rows.join(reps.select("id", "n", "signature"), "id")
    coarse = blocked(crowded, with_signature, "signature", F.col("n"), partial(similar, percent=percent), percent)

    groups = connected_components(coarse)
    sizes = stage(groups.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "sizes")
    members = stage(groups.join(sizes, "component").select(F.col("node").alias("id"), F.col("component").alias("key"), "size"), "members")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), _text(docs, text_col).alias("text"))
    # a merge join at every size: members grow with the documents, so a broadcast would only serve small inputs
    wanted = texts.join(members.hint("merge"), "id")
    sets = stage(shingle_sets(wanted), "sets")  # the texts are moved once, whatever rounds follow
    links = blocked(sets, lambda rows: rows, "shingles", F.octet_length("shingles") / 8, partial(linked, percent=percent), percent)

    components = connected_components(links)
    named = stage(named, "named")
    found = named.join(components, named.rep == components.node, "left")
    return found.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "rep", "id").alias("component_id"))


def op9(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i : i + 4], ' ') END AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.c >= 85 * (x.c + y.c - p.c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT m.doc_id, coalesce(n.c, 0) AS n_shingles, m.component_id, m.doc_id = m.component_id AS kept FROM m LEFT JOIN n ON n.doc_id = m.doc_id
"""
