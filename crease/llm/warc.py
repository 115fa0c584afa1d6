"""Web archives: WARC records with revisits, and the merge of their capture indexes.

Writing: each page is one record.  Of equal payloads of ``min_revisit`` bytes or
more, the page with the largest id is the response and the others revisit it.
Spark's text writer makes the archives (its line separator is the blank lines
that end a record), so they land in any store that Spark writes to, and a lost
task's file is never seen.

Reading: each archive is parsed by the records' own lengths; a response's payload
must match its digest.  The captures of an archive, sorted by URL key, time and
id, are a locally sorted run.  Runs are range-partitioned by that same key -- which
splits even the captures of one hot URL -- and each range merges its part of the k
runs with a loser tree.  The result is ordered globally: partition after
partition, the capture history of every URL key.

Edge cases: a null html is an empty payload; a null URL has an empty URL key; a null
capture time is a record without a date, before all others of its URL key; a
null id is a record without one, never the response of a group unless all ids are
null (then all are responses); records that share the largest id are all
responses; line ends in a URL are percent-coded; an empty table makes no captures;
other columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm.common import ship, stage
from crease.session import scratch_path

MIN_REVISIT = 1000           # bytes
RECORDS_PER_FILE = 2048
RANGE_ROWS = 50_000          # captures merged in one task, about
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURE_SCHEMA = ("urlkey string, captured string, page_id long, url string, payload_bytes long, "
                  "payload_digest string, record_type string, refers_to long, archive string, "
                  "record_offset long")


# ------------------------------------------------------------------ writing
def with_revisits(pages: DataFrame, captured: Column, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, captured, bytes, digest, keeper (null: a response)."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                     captured.alias("captured"))
    p = (p.withColumn("bytes", F.octet_length("html").cast("long"))
         .withColumn("digest", F.sha1(F.col("html").cast("binary"))))
    groups = stage(p.filter(F.col("bytes") >= min_revisit).groupBy("digest")
                   .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1 AND keeper IS NOT NULL").drop("n"), "warc-groups")
    joined = p.join(groups, "digest", "left")
    return joined.withColumn("keeper", F.when(~F.col("page_id").eqNullSafe(F.col("keeper")),
                                              F.col("keeper")))


def record(payload: Column) -> Column:
    """A WARC record without the blank lines that end it."""
    crlf = "\r\n"
    revisit = F.col("keeper").isNotNull()
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit("HTTP/1.1 200 OK" + crlf + "Content-Type: text/html; charset=utf-8" + crlf
                          + "Content-Length: "), F.col("bytes").cast("string"), F.lit(crlf * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(payload))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(crlf)), F.lit(""))

    return F.concat(
        F.lit("WARC/1.1" + crlf),
        field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        field("WARC-Date", F.col("captured")),
        field("WARC-Target-URI", uri),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("keeper").cast("string"), F.lit(">"))),
        field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(crlf), block)


def write_archives(pages: DataFrame, path: str, captured: Column,
                   min_revisit: int = MIN_REVISIT) -> None:
    """Gzipped archives of the pages under ``path``."""
    (with_revisits(pages, captured, min_revisit).select(record(F.col("html")).alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


# ------------------------------------------------------------------ reading
def url_key(url: str | None) -> str:
    """Host labels from the right, then the path and query: ``com,example)/a?b``."""
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", url or "")
    if not m:
        return (url or "").lower()
    host = m[1].lower().rpartition("@")[2]
    host = host[4:] if host.startswith("www.") else host
    return ",".join(reversed(host.split("."))) + ")" + (m[2] or "/")


def parse_archive(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of every record, by the records' lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin, size = end + 4, int(fields["Content-Length"])
        yield at, fields, data[begin:begin + size]
        at = begin + size
        if data[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before {at} has another length")
        at += 4


def _page_of(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:"):-1]) if urn else None


def captures(archive: str, data: bytes) -> list[tuple]:
    """The archive's captures as a run sorted by (URL key, time, id)."""
    out = []
    for offset, f, block in parse_archive(data):
        head, _, payload = block.partition(b"\r\n\r\n")
        n = int(head.rpartition(b"Content-Length: ")[2])
        digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
        if f["WARC-Type"] == "response" and (
                len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"{archive}: the payload at {offset} does not match its digest")
        url = f.get("WARC-Target-URI")
        out.append((url_key(url), f.get("WARC-Date"), _page_of(f.get("WARC-Record-ID")), url, n, digest,
                    f["WARC-Type"], _page_of(f.get("WARC-Refers-To")), archive, offset))
    out.sort(key=capture_order)
    return out


def capture_order(c: tuple) -> tuple:
    """Spark's order of (urlkey, captured, page_id, archive, record_offset)."""
    return (c[0].encode("utf-8"), c[1] is not None, (c[1] or "").encode("utf-8"), c[2] is not None, c[2] or 0,
            c[8].encode("utf-8"), c[9])


_ARROW = pa.schema([("urlkey", pa.string()), ("captured", pa.string()), ("page_id", pa.int64()),
                    ("url", pa.string()), ("payload_bytes", pa.int64()),
                    ("payload_digest", pa.string()), ("record_type", pa.string()),
                    ("refers_to", pa.int64()), ("archive", pa.string()), ("record_offset", pa.int64())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)],
                                      schema=schema)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Sorted runs of all archives: captures with ``run_pos``, their place in the run."""
    ship(spark)
    schema = _ARROW.append(pa.field("run_pos", pa.int64()))

    def parse(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for name, content in zip(part.column(0).to_pylist(), part.column(1)):
                data = zlib.decompress(content.as_py(), wbits=31)
                yield _batch([(*c, i) for i, c in enumerate(captures(name, data))], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content").mapInArrow(
        parse, CAPTURE_SCHEMA + ", run_pos long")


def loser_tree_merge(runs: list[Iterator[tuple]], key) -> Iterator[tuple]:
    """Merge sorted runs.  ``losers[1:]`` holds the loser of each match between
    neighbours, ``losers[0]`` the winner; a new head replays its own path only."""
    k = len(runs)
    heads: list = [None] * k
    keys: list = [None] * k

    def advance(r: int) -> None:
        heads[r] = next(runs[r], None)
        keys[r] = None if heads[r] is None else key(heads[r])

    def beats(a: int, b: int) -> bool:             # an exhausted run loses to all
        if keys[a] is None or keys[b] is None:
            return keys[a] is not None
        return (keys[a], a) < (keys[b], b)

    losers = [-1] * max(k, 1)

    def replay(r: int) -> None:
        node = (r + k) // 2
        while node:
            other = losers[node]
            if other < 0:                          # while building: wait for the opponent
                losers[node] = r
                return
            if beats(other, r):
                losers[node], r = r, other
            node //= 2
        losers[0] = r

    for r in range(k):
        advance(r)
    for r in range(k):
        replay(r)
    while k and heads[losers[0]] is not None:
        r = losers[0]
        yield heads[r]
        advance(r)
        replay(r)


def merge_runs(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All captures in one global order (URL key, time, id), range after range."""
    n = max(1, -(-runs.count() // range_rows))

    def merge(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_run: dict[str, list[tuple]] = {}        # a range's captures, run by run
        for part in parts:
            for row in zip(*(part.column(i).to_pylist() for i in range(len(_ARROW)))):
                by_run.setdefault(row[8], []).append(row)
        out: list[tuple] = []
        for row in loser_tree_merge([iter(r) for r in by_run.values()], capture_order):
            out.append(row)
            if len(out) == 8192:
                yield _batch(out, _ARROW)
                out = []
        yield _batch(out, _ARROW)

    return (runs.repartitionByRange(n, "urlkey", "captured", "page_id", "archive", "record_offset")
            .sortWithinPartitions("archive", "run_pos").drop("run_pos").mapInArrow(merge, CAPTURE_SCHEMA))


def archive_and_index(pages: DataFrame, captured: Column, path: str | None = None) -> DataFrame:
    """Write the pages' archives, read them back, merge their capture indexes."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path, captured)
    return merge_runs(stage(read_runs(spark, path), "warc-runs"))
