"""A message log addressed by offsets, and a streaming source over it.

A log is a folder of appends; an append is one job that writes its messages (envelope
columns and their ``position`` in the log) in segments of ``SEGMENT`` positions, sorted.
It counts once its job has ended.  Positions grow from append to append.

``read_log_stream`` reads a log as a stream: progress is one position, kept in the
query's checkpoint; a micro-batch is the next range of at most ``max_offsets``
positions, cut into ranges of ``TASK_OFFSETS`` that tasks read by themselves, by row
groups.  A range has the same rows whenever it is read, so a batch that is run again
after a crash sees what it saw before.  ``read_log`` is the bounded form, read by Spark's
own Parquet reader with pruned segments.

The stream's tasks open files through Arrow's file systems (local and mounted folders,
``hdfs``, ``s3``, ``gs``): the log must be in a store that they reach.
"""
from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from crease import schema as S
from crease.sources.storage import committed, matching, started

SEGMENT = 50_000             # positions of one segment file
TASK_OFFSETS = 25_000        # positions that one task reads
FORMAT = "message_log"
SCHEMA = StructType(list(S.ENVELOPE.fields)).add("position", LongType())

# workers get these classes by value: no installation of this package on them
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def publish(envelope: DataFrame, path: str, position: Column | None = None, segment: int = SEGMENT) -> int:
    """Append messages to a log, by default at their own offsets; returns the append's number.

    One job: segments are dealt to tasks and sorted there.
    """
    n = max(started(envelope.sparkSession, path, "append"), default=-1) + 1
    at = F.col("offset") if position is None else position
    rows = envelope.withColumn("position", at.cast("long"))
    (rows.withColumn("segment", F.floor(F.col("position") / segment))
     .repartition("segment").sortWithinPartitions("segment", "position")
     .write.partitionBy("segment").parquet(f"{path.rstrip('/')}/append={n}"))
    return n


def read_log(spark: SparkSession, path: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """The envelope rows at positions ``start`` <= position < ``end``."""
    base = path.rstrip("/")
    appends = [f"{base}/append={n}" for n in committed(spark, path, "append")]
    if not appends:
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(SCHEMA).option("basePath", base).parquet(*appends).select(*SCHEMA.fieldNames())
    if start is not None:
        rows = rows.filter(F.col("position") >= start)
    if end is not None:
        rows = rows.filter(F.col("position") < end)
    return rows


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class _LogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        from pyarrow import fs
        self.files, self.base = fs.FileSystem.from_uri(options["path"].rstrip("/"))
        self.most = int(options.get("maxoffsets", 0))
        self.known: dict[str, tuple[int, int]] = {}     # file: first and last position
        self.done: set[str] = set()                     # appends whose files are known
        self.at = int(options.get("resume", -1))
        if self.at < 0:
            self.at = self._bounds()[0]

    def _bounds(self) -> tuple[int, int]:
        """(first position, position after the last) of all complete appends."""
        import pyarrow.parquet as pq
        from pyarrow import fs
        for append in self.files.get_file_info(fs.FileSelector(self.base, allow_not_found=True)):
            # a complete append never changes: it is listed, and its footers are read, once
            if append.type != fs.FileType.Directory or append.path in self.done:
                continue
            found = self.files.get_file_info(fs.FileSelector(append.path, recursive=True))
            if f"{append.path}/_SUCCESS" not in {f.path for f in found}:
                continue
            for f in found:
                if f.extension == "parquet":
                    meta = pq.read_metadata(f.path, filesystem=self.files)
                    column = meta.schema.names.index("position")
                    stats = [meta.row_group(g).column(column).statistics for g in range(meta.num_row_groups)]
                    if stats:
                        self.known[f.path] = (min(s.min for s in stats), max(s.max for s in stats))
            self.done.add(append.path)
        return (min((a for a, _ in self.known.values()), default=0),
                max((b for _, b in self.known.values()), default=-1) + 1)

    def initialOffset(self) -> dict:
        return {"position": self.at}

    def latestOffset(self) -> dict:
        head = max(self._bounds()[1], self.at)
        return {"position": min(head, self.at + self.most) if self.most else head}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        self._bounds()
        lo, hi = start["position"], end["position"]
        self.at = hi
        return [_Range(f, at, min(at + TASK_OFFSETS, hi, b + 1))
                for f, (a, b) in sorted(self.known.items()) if a < hi and b >= lo
                for at in range(max(lo, a), min(hi, b + 1), TASK_OFFSETS)]

    def read(self, partition: _Range) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds
        types = {"timestamp": pa.timestamp("us", tz="UTC")}
        at = ds.field("position")
        rows = ds.dataset(partition.file, filesystem=self.files, format="parquet", partitioning=None)
        for batch in rows.to_batches(columns=SCHEMA.fieldNames(),
                                     filter=(at >= partition.start) & (at < partition.end)):
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [c.cast(types[n]) if n in types else c for n, c in zip(batch.schema.names, batch.columns)],
                    batch.schema.names)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}, "done": set()}    # tasks need their own range only


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return SCHEMA

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _LogReader(dict(self.options))


def resume_position(spark: SparkSession, checkpoint: str) -> int | None:
    """Where the last planned micro-batch of a query ended, from its checkpoint."""
    logs = [p for p in matching(spark, f"{checkpoint.rstrip('/')}/offsets/*") if p.rsplit("/", 1)[1].isdigit()]
    if not logs:
        return None
    last = max(logs, key=lambda p: int(p.rsplit("/", 1)[1]))
    lines = [r["value"] for r in spark.read.text(last, wholetext=True).collect()][0].splitlines()
    return int(json.loads(lines[-1])["position"])


def read_log_stream(spark: SparkSession, path: str, checkpoint: str | None = None,
                    max_offsets: int = 0) -> DataFrame:
    """The log as a stream of envelope rows, from its first position or from where the
    query of ``checkpoint`` is; ``max_offsets`` bounds a micro-batch (0: no bound)."""
    spark.dataSource.register(MessageLog)
    at = resume_position(spark, checkpoint) if checkpoint else None
    return (spark.readStream.format(FORMAT).option("path", path).option("maxOffsets", str(max_offsets))
            .option("resume", str(-1 if at is None else at)).load())


def drain(start: Callable[[], StreamingQuery]) -> None:
    """Run a query until it has seen all that its source holds, then stop it."""
    query = start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
