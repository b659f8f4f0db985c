"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys found in at least min_docs
documents lose their lines in all of them but the one with the largest id. Documents are taken in batches
by falling id. A batch's keys, with the number of documents and the largest id of each, are
merge-anti-joined with the runs: a key that the runs already hold often enough, with a larger id, adds
nothing. The rest becomes a run of the lowest level; a level that has FANOUT runs is compacted
into one run of the next. Runs are bucketed, sorted tables in the shared folder, so that merge joins read them
without a shuffle; a caller may keep them and add later documents to them. DataFrame functions only.

Nulls: a null or empty text is one empty line; a row with a null id counts nowhere and keeps its lines. A repeated row is a
document of its own: it counts, and rows that share the largest id all keep their lines. An empty table gives an empty
result. Short keys always stay. A frequent line is counted map-side within each task, and the places of the lines that go
meet their documents in a join by document, so that a document's work grows with its lines, however many go. Keys are
compared by 128 bits of hash.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import delete, folder, hash128, lower_ascii, stage

MIN_CHARS, MIN_DOCS, FANOUT = 20, 3, 2
#: The least number of batches, and the rows of lines that a batch has at most, about.
BATCHES, BATCH_ROWS = 4, 1 << 30
_BLANK = " \t\n\x0b\x0c\r"


def line_keys(text: Column) -> Column:
    """The key of every line, in order."""
    return F.transform(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "\n", -1), lambda line: F.btrim(line, F.lit(_BLANK)))


class Runs:
    """Levelled runs of (h1, h2, docs, top): a key's number of documents and its largest document id."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = []
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}

    def _write(self, df: DataFrame) -> str:
        name = f"{self.name}_{len(self.paths)}"
        self.paths[name] = folder(self.spark, "line-run")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.repartition(parts, "h1", "h2").write.bucketBy(parts, "h1", "h2").sortBy("h1", "h2").format("parquet").option("path", self.paths[name]).saveAsTable(name)
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE {name}")
            delete(self.spark, self.paths[name])

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, keys: DataFrame) -> None:
        """keys: (h1, h2, id), a row for each document that has the key."""
        batch = keys.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("top"))
        for run in self.tables():
            known = run.where(F.col("docs") >= self.min_docs).select("h1", "h2", F.col("top").alias("known_top"))
            batch = batch.hint("merge").join(known, (batch.h1 == known.h1) & (batch.h2 == known.h2) & (known.known_top >= batch.top), "left_anti")
        self._insert(self._write(batch), 0)

    def _insert(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            merged = self._write(self._merged(self.levels[level]))
            self._drop(self.levels[level])
            self.levels[level] = []
            self._insert(merged, level + 1)

    def _merged(self, names: list[str]) -> DataFrame:
        runs = self.spark.table(names[0])
        for name in names[1:]:
            runs = runs.unionByName(self.spark.table(name))
        return runs.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("top").alias("top"))

    def frequent(self) -> DataFrame:
        """(h1, h2, top) of the keys in at least min_docs documents, of all levels together."""
        names = [name for level in self.levels for name in level]
        return stage(self._merged(names).where(F.col("docs") >= self.min_docs).select("h1", "h2", "top"), "frequent")

    def close(self) -> None:
        self._drop([name for level in self.levels for name in level])
        self.levels = []


def placed_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, text, pos, first, h1, h2) for every line with a long key: the text's hash, the line's place, whether the key stands there first."""
    long_keys = F.filter(F.transform(line_keys(F.col(text_col)), lambda k, i: F.struct(F.char_length(k).alias("n"), *hash128(k), i.alias("pos"))), lambda x: x["n"] >= min_chars)
    ordered = F.array_sort(F.transform(long_keys, lambda x: F.struct(x["h1"].alias("h1"), x["h2"].alias("h2"), x["pos"].alias("pos"))))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text"), ordered.alias("found"))
    # equal keys lie together, so the first of them differs from the one before
    same = lambda x, i: (i > 0) & (F.get("found", i - 1)["h1"] == x["h1"]) & (F.get("found", i - 1)["h2"] == x["h2"])
    marked = F.transform("found", lambda x, i: F.struct("id", "text", x["pos"].alias("pos"), (~F.coalesce(same(x, i), F.lit(False))).alias("first"), x["h1"].alias("h1"), x["h2"].alias("h2")))
    return rows.select(F.explode(marked).alias("line")).select("line.*")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES, runs: Runs | None = None) -> DataFrame:
    """The input's rows and columns with the lines that go taken out of the text, n_lines and n_dropped added.

    runs: those of documents that were deduplicated before; they count, take these documents up and stay open.
    """
    spark = docs.sparkSession
    keys = stage(placed_keys(docs, id_col, text_col, min_chars), "line-keys")

    batches = max(batches, -(-keys.count() // BATCH_ROWS))
    cuts = sorted(set(keys.approxQuantile("id", [i / batches for i in range(1, batches)], 0.1 / batches)), reverse=True)
    own = runs or Runs(spark, min_docs)
    upper, firsts = [None, *cuts], keys.where("first").select("h1", "h2", "id")
    for high, low in zip(upper, [*cuts, None], strict=True):
        part = firsts if high is None else firsts.where(F.col("id") < high)
        own.add(part if low is None else part.where(F.col("id") >= low))
    frequent = own.frequent()
    if runs is None:
        own.close()

    gone = keys.join(frequent, ["h1", "h2"]).where("id < top")
    lists = stage(gone.groupBy("id", F.col("text").alias("hash")).agg(F.collect_set("pos").alias("_gone")), "dropped-lines")
    joined = docs.join(lists, (docs[id_col] == lists["id"]) & (F.xxhash64(docs[text_col]) == lists["hash"]), "left").select(*(docs[c] for c in docs.columns), "_gone")
    lined = joined.withColumn("_lines", F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.when(F.col("_gone").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    n_lines, n_dropped = F.size("_lines").cast("long"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long")
    return lined.select(*[kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns], n_lines.alias("n_lines"), F.greatest(n_dropped, F.lit(0)).alias("n_dropped"))


def op10(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs.select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP10_SQL = """
WITH l AS (
  SELECT doc_id, r.i AS i, r.line AS line,
         translate(trim(r.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, j: {'i': j, 'line': x})) AS r FROM documents)),
f AS (SELECT k, max(doc_id) AS top FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.doc_id, l.i, l.line, f.k IS NOT NULL AND l.doc_id < f.top AS gone FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
