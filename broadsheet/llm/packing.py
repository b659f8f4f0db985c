"""Packing tokenised documents into sequences of a fixed capacity by a configuration linear program.

The lengths of all pieces are counted, which gives a histogram of at most `capacity` numbers whatever the
corpus holds. On the driver the long pieces' lengths are rounded up to at most CLASSES classes, and the linear program
over configurations (multisets of classes that fit into one sequence) is solved by multiplicative weights: each class
has a price that falls exponentially with its coverage, an unbounded-knapsack dynamic program finds the dearest
configurations, and each is taken a small step, never beyond the demand of a class; a class that is covered leaves the
program. Each round's prices prove a lower bound. The fractional solution is rounded down; what remains, a few pieces for
each configuration, and the short pieces, which fill the room that is left, are placed best-fit decreasing, so that the
plan never needs more sequences than best-fit decreasing alone. The plan, whose size also depends on
the histogram alone, is broadcast, and every piece finds its place from its length and its rank among pieces of that
length. Ranks are numbered in shards, so that no length, however frequent, gathers in one task.

Nulls: a null text is empty and still gives one piece of one token, the end id. Only documents longer than the
capacity are cut; their first piece takes the remainder. Repeated rows are packed as often as they come.
An empty table gives an empty result. Ties in rank go by id, piece and checksum. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .pretokens import kept
from .shared import slices, stage

CAPACITY, END_ID, TOKENIZER = 2048, 0, "byte_bpe_50k.json"
#: Of the pieces of one length, about so many are numbered together at most.
SHARD_ROWS = 4096
#: Classes of the program, and the part of the capacity up to which a piece is short.
CLASSES, SHORT = 160, 8
#: Bounds for the room that the program's sequences may leave, one of which is taken.
_ROOMS = (0, 2, 8, 32, 128, 1 << 62)


# ---- tokenised pieces ----------------------------------------------------------------------------
def pieces(docs: DataFrame, keep: dict[str, str], text_col: str = "text", path: str = "", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row for each piece: the columns in keep (name to type), piece, start, length and ids_crc32."""
    path, names = path or public_tokenizers.path(TOKENIZER), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule, cache = kept(path, "byte", lambda r, token: array("I", r.piece(token)).tobytes(), "bytes")
        look, end = cache.__getitem__, np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, "text"):
            at, rows = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                text = text or ""
                tokens = rule.split(text)
                ids = (b"".join(map(look, tokens)) if tokens is not None else np.array(rule.ids(text), "<u4").tobytes()) + end
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                begin = 0
                for piece, stop in enumerate(range(first, total + 1, capacity)):
                    at.append(i)
                    rows.append((piece, begin, stop - begin, zlib.crc32(memoryview(ids)[begin * 4 : stop * 4])))
                    begin = stop
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            picked = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(n).take(picked) for n in names] + [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=[*names, "piece", "start", "length", "ids_crc32"])

    inputs = [F.col(n) for n in names] + [F.col(text_col).alias("text")] * ("text" not in names)
    return docs.select(*inputs).mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in keep.items()), "piece int, start long, length long, ids_crc32 long"]))


# ---- the plan, from the histogram alone ----------------------------------------------------------
@dataclass
class Bins:
    """`count` sequences with the same contents: (length, pieces a sequence) in order."""

    count: int
    free: int
    contents: list[tuple[int, int]] = field(default_factory=list)


def classes(lengths: np.ndarray, counts: np.ndarray, most: int = CLASSES) -> list[slice]:
    """Runs of ascending lengths, at most `most`, in none of which rounding up to the longest adds more tokens than needed for that."""

    def cut(limit: float) -> list[slice]:
        found, end = [], len(lengths)
        while end:
            first, added = end - 1, 0.0
            while first and (more := added + (lengths[end - 1] - lengths[first - 1]) * counts[first - 1]) <= limit:
                first, added = first - 1, more
            found.append(slice(first, end))
            end = first
        return found[::-1]

    low, high = 0.0, float((lengths * counts).sum())
    if len(lengths) <= most:
        return cut(0.0)
    for _ in range(24):
        limit = (low + high) / 2
        low, high = (low, limit) if len(cut(limit)) <= most else (limit, high)
    return cut(high)


def _price(lengths: np.ndarray, values: np.ndarray, capacity: int) -> np.ndarray:
    """The dearest contents for each room up to capacity: unbounded knapsack, a length's multiples a block at a time."""
    best = np.zeros(capacity + 1)
    for length, value in zip(lengths.tolist(), values.tolist(), strict=True):
        for start in range(length, capacity + 1, length):
            end = min(start + length, capacity + 1)
            np.maximum(best[start:end], best[start - length : end - length] + value, out=best[start:end])
    return np.maximum.accumulate(best, out=best)


def _contents(best: np.ndarray, lengths: np.ndarray, values: np.ndarray, room: int) -> list[int]:
    """Indices of the contents that best[room] stands for."""
    found: list[int] = []
    while room >= lengths[0]:
        upto = int(np.searchsorted(lengths, room, side="right"))
        worth = best[room - lengths[:upto]] + values[:upto]
        top = int(worth.argmax())
        if worth[top] < best[room] * (1 - 1e-12):
            room -= 1
        else:
            found.append(top)
            room -= int(lengths[top])
    return found


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, step: float = 0.05, sharp: float = 10.0, near: float = 0.02) -> tuple[dict[tuple[int, ...], float], float]:
    """Multiplicative weights for the program: configuration to how often it is used, and the lower bound that the prices prove.

    A configuration names ascending lengths by index, sorted. Weights begin at counts * lengths, so a length's price, its weight
    over its count, is length * exp(-sharp * coverage). A round takes the configurations that are within `near` of the
    dearest, each by at most `step` of any length and never beyond a coverage of 1. Each round covers some length by a
    step or wholly, so there are at most (1 / step + 1) rounds for each length.
    """
    covered, open_ = np.zeros(len(lengths)), np.ones(len(lengths), bool)
    used: dict[tuple[int, ...], float] = {}
    proven = 0.0
    while open_.any():
        left = np.flatnonzero(open_)
        floor = covered[left].min()
        sizes, values = lengths[left], lengths[left] * np.exp(-sharp * (covered[left] - floor))
        best = _price(sizes, values, capacity)
        proven = max(proven, float((counts[left] * values).sum() / best[capacity]))
        gain = values + best[capacity - sizes]
        dear = [int(i) for i in np.argsort(-gain, kind="stable") if gain[i] >= (1 - near) * gain.max()]
        for nth, i in enumerate(dear):
            if nth and covered[left[i]] > floor + step:
                continue
            items = left[[i, *_contents(best, sizes, values, capacity - int(sizes[i]))]]
            kinds, times = np.unique(items, return_counts=True)
            if not open_[kinds].all() or nth and covered[kinds].max() > floor + 2 * step:
                continue
            amount = float((np.minimum(step, 1 - covered[kinds]) * counts[kinds] / times).min())
            config = tuple(sorted(items.tolist()))
            used[config] = used.get(config, 0.0) + amount
            covered[kinds] += amount * times / counts[kinds]
            open_[kinds] = covered[kinds] < 1 - 1e-9
    return used, proven


def _filled(whole: int, capacity: int, wanted: list[tuple[list[list[int]], int]]) -> list[Bins]:
    """whole sequences that take the given numbers of pieces from pools of [length, pieces left], longest last."""
    found: list[Bins] = []
    while whole:
        if all(pool[-1][1] >= times for pool, times in wanted):
            count = min(whole, *(pool[-1][1] // times for pool, times in wanted))
            contents = [(pool[-1][0], times) for pool, times in wanted]
        else:  # one sequence whose pieces of a class differ in length
            count, contents = 1, []
            for pool, times in wanted:
                at = -1
                while times:
                    taken = min(times, pool[at][1])
                    contents.append((pool[at][0], taken))
                    times, at = times - taken, at - 1
        found.append(Bins(count, capacity - sum(k * t for k, t in contents), contents))
        whole -= count
        held = dict.fromkeys((k for k, _ in contents), 0)
        for k, t in contents:
            held[k] += count * t
        for pool, _ in wanted:
            for entry in pool:
                entry[1] -= held.get(entry[0], 0)
            while pool and not pool[-1][1]:
                pool.pop()
    return found


def program(histogram: dict[int, int], capacity: int = CAPACITY, short: int = SHORT) -> tuple[list[Bins], dict[int, int]]:
    """Sequences that the rounded program fills with long pieces, and the pieces it leaves."""
    left = {k: n for k, n in histogram.items() if n > 0}
    lengths = np.array(sorted(k for k in left if k * short > capacity), np.int64)
    if not len(lengths):
        return [], left
    counts = np.array([left[k] for k in lengths.tolist()], float)
    runs = classes(lengths, counts)
    used, _ = fractional(np.array([lengths[r.stop - 1] for r in runs]), np.array([counts[r].sum() for r in runs]), capacity)
    pools = [[[k, left[k]] for k in lengths[r].tolist()] for r in runs]
    bins: list[Bins] = []
    for config, amount in sorted(used.items(), key=lambda x: (-x[1], x[0])):
        kinds, times = np.unique(config, return_counts=True)
        bins += _filled(int(amount + 1e-6), capacity, [(pools[k], t) for k, t in zip(kinds.tolist(), times.tolist(), strict=True)])
    for bin_ in bins:
        for k, t in bin_.contents:
            left[k] -= bin_.count * t
    return bins, {k: n for k, n in left.items() if n}


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Bins]:
    """Groups of alike sequences that hold every piece of the histogram once.

    Rounding lengths up to classes leaves room in the program's sequences. Those with more than some room are taken apart
    again before best-fit places what remains; of several such bounds the one that needs the fewest sequences counts.
    """
    solved, left = program(histogram, capacity)
    found = _best_fit([], {k: n for k, n in histogram.items() if n > 0}, capacity)
    for room in _ROOMS:
        kept = [Bins(b.count, b.free, list(b.contents)) for b in solved if b.free <= room]
        rest = Counter(left)
        for b in solved:
            if b.free > room:
                for k, t in b.contents:
                    rest[k] += b.count * t
        packed = _best_fit(kept, rest, capacity)
        if kept and sum(b.count for b in packed) <= sum(b.count for b in found):
            found = packed
    return found


def _best_fit(bins: list[Bins], left: dict[int, int], capacity: int) -> list[Bins]:
    """Best-fit decreasing of the remaining lengths into groups of sequences, split where only some take a piece."""
    room: list[tuple[int, int]] = sorted((b.free, i) for i, b in enumerate(bins) if b.free)
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(room, (length, -1))
            if at == len(room):
                each = capacity // length
                whole, rest = divmod(n, each)
                for count, times in ((whole, each), (1, rest)):
                    if count and times:
                        bins.append(Bins(count, capacity - times * length, [(length, times)]))
                        if bins[-1].free:
                            bisect.insort(room, (bins[-1].free, len(bins) - 1))
                break
            free, i = room.pop(at)
            group = bins[i]
            times = min(free // length, n)
            count = min(group.count, n // times)
            taken = Bins(count, free - times * length, [*group.contents, (length, times)])
            n -= count * times
            if count < group.count:
                bins[i] = Bins(group.count - count, free, group.contents)
                bisect.insort(room, (free, i))
                bins.append(taken)
                i = len(bins) - 1
            else:
                bins[i] = taken
            if taken.free:
                bisect.insort(room, (taken.free, i))
    return bins


def segments(bins: list[Bins]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces a sequence, first sequence, offset) for every entry of every group."""
    rank: dict[int, int] = {}
    out, base = [], 0
    for group in bins:
        offset = 0
        for length, times in group.contents:
            first = rank.get(length, 0)
            rank[length] = first + group.count * times
            out.append((length, first, rank[length], times, base, offset))
            offset += length * times
        base += group.count
    return out


# ---- the operator --------------------------------------------------------------------------------
def _table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    names = ("length", "first", "end", "times", "base", "offset0")
    return spark.createDataFrame(rows, T.StructType([T.StructField(f"seg_{n}", T.LongType()) for n in names]))


def pack(parts: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Adds sequence_id and offset to rows that have a length of 1 to capacity. parts is written once and reread."""
    parts = stage(parts.withColumn("_h", F.xxhash64(*order)), "pieces")
    histogram = {r.length: r.n for r in parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")).limit(capacity + 1).collect()}
    shards = max(64, -(-max(histogram.values(), default=1) // SHARD_ROWS))
    table = _table(parts.sparkSession, segments(plan(histogram, capacity)))  # its size follows the histogram

    keyed = parts.withColumn("_shard", F.pmod("_h", F.lit(shards)))
    sizes = stage(keyed.groupBy("length", "_shard").agg(F.count(F.lit(1)).alias("_n")), "shards")
    before = sizes.select("length", "_shard", (F.sum("_n").over(Window.partitionBy("length").orderBy("_shard")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("length", "_shard").orderBy(*order)) - 1
    ranked = keyed.withColumn("_local", local).join(before, ["length", "_shard"]).withColumn("_rank", F.col("_before") + F.col("_local"))
    inside = (F.col("length") == F.col("seg_length")) & (F.col("_rank") >= F.col("seg_first")) & (F.col("_rank") < F.col("seg_end"))
    place = F.col("_rank") - F.col("seg_first")
    placed = ranked.join(F.broadcast(table), inside)
    return placed.select(
        *[c for c in parts.columns if c != "_h"],
        (F.col("seg_base") + F.floor(place / F.col("seg_times"))).cast("long").alias("sequence_id"),
        (F.col("seg_offset0") + place % F.col("seg_times") * F.col("length")).cast("long").alias("offset"),
    )


def op4(docs: DataFrame) -> DataFrame:
    return pack(pieces(docs, {"doc_id": "long"})).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
