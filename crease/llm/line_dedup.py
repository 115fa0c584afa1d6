"""Line deduplication with levelled sorted runs of line hashes.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z in lower
case; keys found in ``min_docs`` documents or more lose all their lines.

Documents are dealt to batches.  A batch's line keys become one table of
(128-bit hash, documents that hold it); the batch anti-joins the hashes that the
runs so far already settle (``min_docs`` documents or more), and the rest is
added as a sorted run of level 0.  When a level holds ``fanout`` runs they are
merged, hash by hash, into one run of the next level.  All runs together then
name the frequent keys, and each document drops their lines.

Hot keys: counts are summed per Arrow batch, per task and only then per hash, so
a line that every document holds is one row a task.  No table of whole lines is
ever grouped; the shuffles carry 16-byte hashes, and the texts move once, by
document, when dropped lines are known.

Edge cases: a null or empty text is one empty line, whose key is too short to
drop; a text that loses all its lines becomes empty; repeated rows count as
documents of their own; documents are matched to their dropped lines by doc_id
and text, so repeated or null doc_ids do no harm; an empty table gives no rows;
other columns are handed on under their own names.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm.common import delete_path, free_name, map_arrow, own_columns, ship
from crease.session import scratch_path

MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 2
BLANK = " \t\n\x0b\x0c\r"
RUN_SCHEMA = "hash binary, docs long"


def line_key(line: str) -> bytes:
    """The key's UTF-8 bytes; ``bytes.lower`` changes A-Z alone."""
    return line.strip(BLANK).encode("utf-8").lower()


def line_hash(line: str, min_chars: int) -> bytes | None:
    key = line_key(line)
    return xxhash.xxh3_128_digest(key) if len(key.decode("utf-8")) >= min_chars else None


class SortedRuns:
    """Runs of (hash, docs) sorted by hash, on levels; all of them Parquet folders
    in the shared scratch folder."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"line-run-l{level}")
        rows.repartitionByRange("hash").sortWithinPartitions("hash").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(RUN_SCHEMA).parquet(*paths)

    def _merged(self, paths: list[str]) -> DataFrame:
        return self._read(paths).groupBy("hash").agg(F.sum("docs").alias("docs"))

    def settled(self, min_docs: int) -> DataFrame | None:
        """Hashes that the runs already give ``min_docs`` documents or more."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return None
        return self._merged(paths).filter(F.col("docs") >= min_docs).select("hash")

    def add(self, batch: DataFrame, min_docs: int) -> None:
        """Anti-join a batch of (hash, docs) against the runs and add what is left."""
        known = self.settled(min_docs)
        self._write(batch if known is None else batch.join(known, "hash", "left_anti"), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._write(self._merged(old), level + 1)
            for p in old:
                delete_path(self.spark, p)
            level += 1


def batch_counts(docs: DataFrame, batches: int = BATCHES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(batch, hash, docs): in how many documents of a batch each line key occurs."""
    ship(docs.sparkSession)

    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            seen: Counter = Counter()
            for batch, text in zip(part.column(0).to_pylist(), part.column(1)):
                keys = {line_hash(x, min_chars) for x in (text.as_py() or "").split("\n")}
                keys.discard(None)
                seen.update((batch, k) for k in keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _ in seen], pa.int32()),
                 pa.array([k for _, k in seen], pa.binary()),
                 pa.array(list(seen.values()), pa.int64())], ["batch", "hash", "docs"])

    dealt = docs.select(F.expr(f"cast(pmod(xxhash64(doc_id, text), {batches}) as int)").alias("batch"),
                        "text")
    return (dealt.mapInArrow(count, "batch int, hash binary, docs long")
            .groupBy("batch", "hash").agg(F.sum("docs").alias("docs")))


def frequent_hashes(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                    batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """Hashes of the line keys found in ``min_docs`` documents or more."""
    spark = docs.sparkSession
    counted = scratch_path(spark, "line-batches")
    batch_counts(docs, batches, min_chars).write.partitionBy("batch").parquet(counted)
    runs = SortedRuns(spark, fanout)
    found = spark.read.schema("hash binary, docs long, batch int").parquet(counted)
    for b in range(batches):
        runs.add(found.filter(F.col("batch") == b).select("hash", "docs"), min_docs)
    delete_path(spark, counted)
    path = scratch_path(spark, "line-frequent")
    runs.settled(min_docs).write.parquet(path)
    for level in runs.levels:
        for p in level:
            delete_path(spark, p)
    return spark.read.schema("hash binary").parquet(path)


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                        batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with the frequent lines out of ``text``, and the columns
    ``n_lines`` and ``n_dropped`` (renamed if they clash)."""
    frequent = frequent_hashes(docs, min_docs, min_chars, batches, fanout)

    def hashes(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys = [part.column(0).to_pylist(), part.column(1).to_pylist()]
            out: list[list] = [[], [], []]
            for k1, k2, text in zip(*keys, part.column(2)):
                found = {line_hash(x, min_chars) for x in (text.as_py() or "").split("\n")}
                found.discard(None)
                for h in found:
                    out[0].append(k1)
                    out[1].append(k2)
                    out[2].append(h)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.binary())], ["k1", "k2", "hash"])

    # a document is its id and text: equal rows lose equal lines, so they may share a key
    key = [F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "text", "doc_id")]
    k1, k2, gone = (free_name(docs, n) for n in ("line_k1", "line_k2", "line_gone"))
    lost = (docs.select(key[0].alias("k1"), key[1].alias("k2"), "text")
            .mapInArrow(hashes, "k1 long, k2 long, hash binary")
            .join(frequent, "hash", "left_semi")
            .groupBy(F.col("k1").alias(k1), F.col("k2").alias(k2))
            .agg(F.collect_set("hash").alias(gone)))      # at most the document's own lines
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    keyed = docs.withColumn(k1, key[0]).withColumn(k2, key[1])
    columns = docs.columns
    at = columns.index("text")

    def strip(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, totals, drops = [], [], []
            for text, out in zip(part.column(at), part.column(len(columns))):
                lines = (text.as_py() or "").split("\n")
                drop = set(out.as_py() or ())
                kept = [x for x in lines if line_hash(x, min_chars) not in drop] if drop else lines
                texts.append("\n".join(kept))
                totals.append(len(lines))
                drops.append(len(lines) - len(kept))
            arrays = [part.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(texts, arrays[at].type)
            yield pa.RecordBatch.from_arrays(
                arrays + [pa.array(totals, pa.int64()), pa.array(drops, pa.int64())],
                [*columns, n_lines, n_dropped])

    joined = keyed.join(lost, [k1, k2], "left").select(*own_columns(docs), gone)
    schema = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()),
                           T.StructField(n_dropped, T.LongType())])
    return map_arrow(joined, strip, schema)
