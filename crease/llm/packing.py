"""Best-fit packing by bin-completion branch and bound.

1. ``token_pieces``: tokenise every document (ids + end id) and cut documents
   longer than a sequence; the first piece takes the remainder.
2. ``solve``: only piece *lengths* matter for the packing, so it works on the
   histogram of lengths -- at most ``capacity`` rows whatever the corpus holds.
   A best-fit-decreasing packing is the incumbent; the search then completes
   bins around the largest remaining length with undominated fillings, prunes
   by the waste that a better packing may still have, and stops at the lower
   bound.  A solution is a list of (filling, how many sequences use it).
3. ``place``: every piece gets a rank among the pieces of its length; ranks map
   to (sequence, offset) through the solution's slots.  Ranks come from
   (length, bucket) counts plus a row number inside a bucket of bounded size,
   so a length that holds a third of all pieces is spread over many tasks.

Edge cases: a null text is an empty one (its end id alone, length 1); repeated
rows and repeated doc_ids are packed once per row; an empty table gives no
rows; other columns of the input are ignored.
"""
from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import ship, stage

CAPACITY = 1024
END_ID = 2
SEARCH_NODES = 3000          # nodes of the branch and bound; the incumbent stands beyond it
BUCKET_ROWS = 1 << 11        # pieces numbered in one window partition
CACHE_WORDS = 1 << 18        # distinct words a worker remembers before they age: 100 MB with the older ones
LONGEST_CACHED = 64          # characters of a remembered word

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

_TOKENIZERS: dict[str, "WordTokenizer"] = {}      # per worker process
_TWO_SPACES = re.compile(r"\s\s")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"      # ASCII, but for the apostrophe


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    take the code points from 256 on, in byte order."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class _Parts(dict):
    """Packed ids of text parts, computed when first asked for.

    ``age`` makes the parts so far the older ones: an older part that is asked for
    again stays, the others go with the next ageing.
    """

    def __init__(self, compute):
        self.compute = compute
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        got = self.older.get(part)
        if got is None:
            got = self.compute(part)
        if len(part) <= LONGEST_CACHED:
            self[part] = got
        return got

    def age(self) -> None:
        self.older = dict(self)
        self.clear()


class WordTokenizer:
    """Token ids of texts as packed little-endian uint32, with a cache of words.

    The byte-level pre-tokenizer always starts a new piece at a space between
    two non-space characters, so a text's ids are the ids of its parts between
    such spaces, one after another.  Parts repeat, hence the cache; a part of
    letters alone is one pre-token and goes straight to the model's merges.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._merges = self._tok.model.tokenize
        self._letters = dict(enumerate(_byte_letters()))
        self._newline = self._encode("\n")
        self._first = _Parts(lambda part: self._ids(part, ""))      # at the start of a line
        self._rest = _Parts(lambda part: self._ids(part, " "))      # after a space

    def _encode(self, text: str) -> bytes:
        return _pack(self._tok.encode(text, add_special_tokens=False).ids)

    def _ids(self, part: str, space: str) -> bytes:
        """Ids of ``part``, which has no space inside, after ``space`` (" " or "")."""
        if part.isalpha():                       # one pre-token
            mapped = (space + part).encode("utf-8").decode("latin-1").translate(self._letters)
            return _pack([t.id for t in self._merges(mapped)])
        core = part.rstrip(_PUNCTUATION)
        if core.isalpha():                       # letters, then one run of punctuation
            return (self._rest if space else self._first)[core] + self._first[part[len(core):]]
        if "\n" in part and (lines := part.split("\n")) == part.split():
            # a lone line feed between two other characters is a pre-token
            return self._newline.join([(self._rest if space else self._first)[lines[0]],
                                       *map(self._first.__getitem__, lines[1:])])
        return self._encode(space + part)

    def packed_ids(self, text: str) -> bytes:
        if len(self._rest) + len(self._first) > CACHE_WORDS:
            self._rest.age()
            self._first.age()
        parts = text.split(" ") if not _TWO_SPACES.search(text) else _LONE_SPACE.split(text)
        if parts[-1] == "" or parts[0] == "":          # a space at either end
            return self._encode(text)
        return self._first[parts[0]] + b"".join(map(self._rest.__getitem__, parts[1:]))


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    ship(docs.sparkSession)
    end = end_id.to_bytes(4, "little")
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer_path)
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tok.packed_ids(text.as_py() or "") + end
                n, at, piece = len(ids) // 4, 0, 0
                while at < n:
                    size = min(n, n % capacity or capacity) if at == 0 else capacity
                    row = (doc_id, piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]))
                    for c, v in zip(cols, row):
                        c.append(v)
                    at, piece = at + size, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, PIECE_SCHEMA)


# ------------------------------------------------------------------ the search
Filling = tuple[int, ...]                                   # lengths, longest first


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences any packing needs: by total length, and by pieces over half a
    sequence, which never share one (for each threshold k, what pieces from k
    to a half can't find beside them needs further sequences)."""
    total = sum(n * c for n, c in counts.items())
    best = -(-total // capacity)
    big = [(n, c) for n, c in counts.items() if 2 * n > capacity]
    for k in [0, *[n for n in counts if 2 * n <= capacity]]:
        n1 = sum(c for n, c in big if n > capacity - k)
        n2 = sum(c for n, c in big if n <= capacity - k)
        room = sum(c * (capacity - n) for n, c in big if n <= capacity - k)
        small = sum(n * c for n, c in counts.items() if k <= n and 2 * n <= capacity)
        best = max(best, n1 + n2 + max(0, -(-(small - room) // capacity)))
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best fit, longest first, for whole groups of equal sequences at a time."""
    groups: dict[int, dict[Filling, int]] = {capacity: {}}   # by room left
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = min((r for r in groups if r >= n and groups[r]), default=None)
            if room is None:                                 # open new sequences
                room, filling, have = capacity, (), left
            else:
                filling, have = groups[room].popitem()
            each = room // n
            full = min(have, left // each)
            taken = full
            if full:
                _add(groups, room - each * n, filling + (n,) * each, full)
                left -= full * each
            if left and full < have and left < each:         # the last, partly filled one
                _add(groups, room - left * n, filling + (n,) * left, 1)
                left, taken = 0, taken + 1
            if filling and have > taken:
                _add(groups, room, filling, have - taken)
    return [(f, c) for g in groups.values() for f, c in g.items() if f]


def _add(groups: dict, room: int, filling: Filling, n: int) -> None:
    g = groups.setdefault(room, {})
    g[filling] = g.get(filling, 0) + n


def _fits_into(small: Filling, large: Filling) -> bool:
    """Whether the pieces of ``small`` can be put into places sized as ``large``."""
    if not small:
        return True
    return any(small[0] <= room and _fits_into(
        small[1:], tuple(sorted(large[:i] + large[i + 1:] + (room - small[0],), reverse=True)))
        for i, room in enumerate(large))


def undominated_fillings(room: int, lengths: list[int], left: dict[int, int],
                         keep: int = 6) -> list[Filling]:
    """Maximal fillings of ``room``, the least waste first, without those whose
    pieces fit into the places of another one.  ``lengths`` ascends."""
    found: set[Filling] = set()

    def complete(start: Filling) -> None:
        filling, rest = list(start), room - sum(start)
        while rest:
            i = bisect.bisect_right(lengths, rest)
            while i and left[lengths[i - 1]] <= filling.count(lengths[i - 1]):
                i -= 1
            if not i:
                break
            filling.append(lengths[i - 1])
            rest -= lengths[i - 1]
        found.add(tuple(sorted(filling, reverse=True)))

    upto = bisect.bisect_right(lengths, room)
    if upto and lengths[upto - 1] == room:
        return [(room,)]                    # dominates every other filling
    complete(())
    for i in range(upto - 1, -1, -1):
        a = lengths[i]
        complete((a,))
        j = min(bisect.bisect_right(lengths, room - a), i + 1) - 1
        for b in lengths[max(0, j - 1):j + 1]:
            if b != a or left[a] > 1:
                complete((a, b))
    best = sorted(found, key=lambda f: (room - sum(f), len(f), [-x for x in f]))[:4 * keep]
    out: list[Filling] = []
    for f in best:
        if len(f) > 4 or not any(len(g) <= 4 and _fits_into(f, g) for g in out):
            out.append(f)
        if len(out) == keep:
            break
    return out


def solve(counts: dict[int, int], capacity: int = CAPACITY,
          nodes: int = SEARCH_NODES) -> list[tuple[Filling, int]]:
    """Fillings and how many sequences use each; every piece is placed once."""
    counts = {n: c for n, c in counts.items() if c}
    incumbent = best_fit_decreasing(counts, capacity)
    least, total = lower_bound(counts, capacity), sum(n * c for n, c in counts.items())
    used = sum(c for _, c in incumbent)
    if used <= least:
        return incumbent
    left = dict(counts)
    path: list[tuple[Filling, int]] = []        # fillings on the way to the current node
    todo: list[list[Filling]] = []              # alternatives still open at each node
    bins = waste = 0
    while nodes:
        nodes -= 1
        lengths = sorted(n for n, c in left.items() if c)
        if not lengths:
            if bins < used:
                incumbent, used = list(path), bins
                if used <= least:
                    break
            options: list[Filling] = []
        else:
            top = lengths[-1]
            left[top] -= 1
            have = lengths if left[top] else lengths[:-1]
            options = [(top, *f) for f in undominated_fillings(capacity - top, have, left)]
            left[top] += 1
            options.reverse()                   # pop() then takes the best first
        todo.append(options)
        # a packing of used - 1 sequences leaves this much waste and no more
        while todo:
            allowed = (used - 1) * capacity - total
            step = None
            while todo[-1] and step is None:
                f = todo[-1].pop()
                n = min(left[x] // f.count(x) for x in set(f))
                if waste + n * (capacity - sum(f)) <= allowed:
                    step = (f, n)
            if step:
                break
            todo.pop()
            if path:
                f, n = path.pop()
                for x in f:
                    left[x] += n
                bins, waste = bins - n, waste - n * (capacity - sum(f))
        if not todo:
            break                               # nothing better exists among these fillings
        f, n = step
        for x in f:
            left[x] -= n
        path.append(step)
        bins, waste = bins + n, waste + n * (capacity - sum(f))
    return incumbent


def slots(solution: list[tuple[Filling, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies a sequence, first sequence, offset)."""
    out, taken, sequence = [], {}, 0
    for filling, n in solution:
        at = 0
        for length in sorted(set(filling), reverse=True):
            copies, first = filling.count(length), taken.get(length, 0)
            out.append((length, first, first + copies * n, copies, sequence, at))
            taken[length] = first + copies * n
            at += copies * length
        sequence += n
    return out


def place(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to staged pieces."""
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # <= capacity rows
    # one row per length and filling: bounded by the search, not by the corpus
    table = spark.createDataFrame(
        slots(solve(counts, capacity, nodes)),
        "s_length long, s_from long, s_to long, s_copies long, s_first long, s_at long")
    buckets = spark.createDataFrame(
        [(n, max(1, -(-c // BUCKET_ROWS))) for n, c in counts.items()], "length long, s_buckets long")
    key = [F.col(c) for c in ("doc_id", "piece", "ids_crc32", "start")]
    dealt = (pieces.join(F.broadcast(buckets), "length")
             .withColumn("s_bucket", F.expr("pmod(xxhash64(doc_id, piece, ids_crc32), s_buckets)")))
    before = Window.partitionBy("length").orderBy("s_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    base = (dealt.groupBy("length", "s_bucket").agg(F.count(F.lit(1)).alias("s_n"))
            .withColumn("s_base", F.coalesce(F.sum("s_n").over(before), F.lit(0))).drop("s_n"))
    ranked = (dealt.join(base, ["length", "s_bucket"])
              .withColumn("s_rank", F.col("s_base") - 1 + F.row_number().over(
                  Window.partitionBy("length", "s_bucket").orderBy(*key))))
    j = F.col("s_rank") - F.col("s_from")
    return (ranked.join(F.broadcast(table), (F.col("length") == F.col("s_length"))
                        & (F.col("s_rank") >= F.col("s_from")) & (F.col("s_rank") < F.col("s_to")))
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("s_first") + F.expr("(s_rank - s_from) div s_copies")).alias("sequence_id"),
                    (F.col("s_at") + j % F.col("s_copies") * F.col("length")).alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY,
                   end_id: int = END_ID, nodes: int = SEARCH_NODES) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    pieces = stage(token_pieces(docs, tokenizer_path, capacity, end_id), "pack-pieces")
    return place(pieces, capacity, nodes)
