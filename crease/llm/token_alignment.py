"""Alignment of two tokenizers' tokens, counted over inverted pair bitmaps.

A text is encoded by tokenizer A (byte-level BPE, a space put before the text) and by
tokenizer B (sentence pieces, which puts the space itself).  Byte offsets where a
token of A and one of B both end cut the text into groups; the two tokens that end
there are linked.

* **Links.**  Both tokenizers cut at a space between two non-space characters, so
  the tokens, groups and links of a text are those of its parts between such
  spaces, one after another; a worker remembers the parts it has met.
* **Inverted pair bitmaps.**  Documents are numbered in chunks of at most
  ``CHUNK_DOCS``.  A linked pair (id of A, id of B) has in every chunk one document
  bitmap a multiplicity plane: plane j holds the documents whose number of links of
  that pair has bit j.  A bitmap is stored as its sorted 16-bit numbers or as plain
  bits, whichever is smaller.  The bitmaps of a chunk's slices are OR-merged when
  the chunk is full; over chunks, a pair's bitmap is the row of its chunks' bitmaps.
* **Counts.**  Popcounts: of the planes' union for documents, of plane j times 2^j
  for links, added up over chunks.
* **Scores.**  Every posting (pair, chunk) gets its pair's count, and whether no
  other pair of the same B id has more; chunk by chunk the bitmaps give these back
  to the documents.

A pair that all texts hold has one row a chunk, so no key is hot; a chunk is bounded
in documents and links, but for the one text that fills it.  All tables are staged
under the shared checkpoint folder.

Edge cases: null and empty texts, and texts whose tokens do not spell space + text
byte for byte (a text with U+2581), have no tokens: zeros and an empty digest; a null
doc_id is passed on; repeated rows are separate documents; an empty table gives no
rows; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import ship, stage
from crease.llm.packing import _byte_letters

CHUNK_DOCS = 4096            # documents of one bitmap, at most 65,536
CHUNK_LINKS = 1 << 20        # a chunk ends with the text that brings it to so many links
SLICE_DOCS = 128             # texts encoded together
CACHE_BYTES = 160 << 20      # of remembered parts in a worker, about
PART_BYTES = 350             # of a remembered part besides its digest form and links
LONGEST_CACHED = 64          # characters of a remembered part

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}   # per worker process

INDEX_SCHEMA = ("chunk long, pos int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
                "a int, b int, n_docs long, n_links long, planes array<binary>")


# what is known of one part of a text: tokens of A and B, groups, the groups' digest
# form, the links as packed 64-bit pairs
Part = tuple[int, int, int, bytes, bytes]


def byte_level_bytes(vocabulary: dict[str, int]) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    byte = {c: i for i, c in enumerate(_byte_letters())}
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(byte[c] for c in token)
    return out


class Aligner:
    """Aligned parts of texts under two tokenizers."""

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        with open(a_path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self._a_bytes = byte_level_bytes(
            {t: i for t, i in model["vocab"].items() if not t.startswith("<|")})
        # merges are numbered in order of their ids: the id is the rank, and the same
        # merges run several times faster without the offsets of an encoding
        self._a = tiktoken.Encoding("byte-level", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                    mergeable_ranks={t: i for i, t in enumerate(self._a_bytes) if t})
        self._b = b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self._b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                         else b.id_to_piece(i).replace("▁", " ").encode()
                         for i in range(b.get_piece_size())]
        self._a_length = np.array([len(t) for t in self._a_bytes])
        self._b_length = np.array([len(t) for t in self._b_bytes])
        # an id inside a group, and as the last of its side
        n_a, n_b = len(self._a_bytes), len(self._b_bytes)
        self._names = ([f"{i}," for i in range(n_a)] + [f"{i}|" for i in range(n_a)]
                       + [f"{i}," for i in range(n_b)] + [f"{i};" for i in range(n_b)])
        self._parts: dict[str, Part | None] = {}
        self._size = 0

    def _learn(self, parts: list[str]) -> None:
        if not parts:
            return
        spelled = [" " + p for p in parts]
        a = [self._a.encode_ordinary(p) for p in spelled]
        b = self._b.encode(parts, num_threads=1)
        good = []
        for k, text in enumerate(spelled):
            if b"".join([self._b_bytes[t] for t in b[k]]) == text.encode():
                good.append(k)
            else:
                self._parts[parts[k]] = None
        if not good:
            return
        n_a, n_b = [np.array([len(x[k]) for k in good]) for x in (a, b)]
        ids_a, ids_b = [np.fromiter((t for k in good for t in x[k]), np.int64) for x in (a, b)]
        # the parts one after another: their ends are ends on both sides
        ends_a, ends_b = np.cumsum(self._a_length[ids_a]), np.cumsum(self._b_length[ids_b])
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, shared), np.searchsorted(ends_b, shared)
        links = (ids_a[last_a] << 32 | ids_b[last_b]).tobytes()
        width_a, width_b = len(self._a_bytes), len(self._b_bytes)
        name_a, name_b = ids_a.copy(), ids_b + 2 * width_a
        name_a[last_a] += width_a
        name_b[last_b] += width_b
        order = np.argsort(np.r_[2 * np.searchsorted(shared, ends_a), 2 * np.searchsorted(shared, ends_b) + 1],
                           kind="stable")
        text = [self._names[i] for i in np.r_[name_a, name_b][order].tolist()]
        tokens = np.cumsum(n_a + n_b).tolist()
        groups = (np.searchsorted(shared, ends_a[np.cumsum(n_a) - 1]) + 1).tolist()
        t0 = g0 = 0
        for k, t1, g1, x, y in zip(good, tokens, groups, n_a.tolist(), n_b.tolist()):
            spell = "".join(text[t0:t1])[:-1].encode()
            self._parts[parts[k]] = (x, y, g1 - g0, spell, links[8 * g0:8 * g1])
            self._size += len(spell) + 8 * (g1 - g0) + PART_BYTES
            t0, g0 = t1, g1

    def align(self, texts: list[str]) -> list[list[Part] | None]:
        """The parts of each text; None for a text without tokens."""
        if self._size > CACHE_BYTES:
            self._parts, self._size = {}, 0
        cut = [_LONE_SPACE.split(t) if t else [] for t in texts]
        known = self._parts
        new = [p for p in dict.fromkeys(p for parts in cut for p in parts) if p not in known]
        self._learn(new)
        out: list[list[Part] | None] = []
        for parts in cut:
            got = [known[p] for p in parts]
            out.append(got if got and all(got) else None)
        for p in new:
            if len(p) > LONGEST_CACHED:
                gone = known.pop(p)
                self._size -= len(gone[3]) + len(gone[4]) + PART_BYTES if gone else 0
        return out


def _aligner(a_path: str, b_path: str) -> Aligner:
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_path, b_path)
    return _ALIGNERS[key]


# ------------------------------------------------------------------ bitmaps of a chunk
def pack_bitmap(numbers: np.ndarray) -> bytes:
    """Ascending document numbers as a bitmap: a byte for the form, then the smaller form."""
    bits = int(numbers[-1]) // 8 + 1
    if 2 * len(numbers) <= bits:
        return b"\0" + numbers.astype("<u2").tobytes()
    plain = np.zeros(bits * 8, np.uint8)
    plain[numbers] = 1
    return b"\1" + np.packbits(plain).tobytes()


def unpack_bitmap(bitmap: bytes) -> np.ndarray:
    if bitmap[0] == 0:
        return np.frombuffer(bitmap, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1)))


def chunk_bitmaps(links: list[np.ndarray], docs: list[np.ndarray]) -> Iterator[tuple[int, int, int, list[bytes]]]:
    """(pair, documents, links, planes) of every pair in a chunk's slices, merged."""
    pair, doc = np.concatenate(links), np.concatenate(docs)
    order = np.lexsort((doc, pair))
    pair, doc = pair[order], doc[order]
    first = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])])
    times = np.diff(np.r_[first, len(pair)])
    pair, doc = pair[first], doc[first]
    begin = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
    for lo, hi in zip(begin, np.r_[begin[1:], len(pair)]):
        d, t = doc[lo:hi], times[lo:hi]
        top = int(t.max())
        if top == 1:
            planes = [pack_bitmap(d)]
        else:
            planes = []
            for j in range(top.bit_length()):
                on = d[(t >> j) & 1 == 1]
                planes.append(pack_bitmap(on) if len(on) else b"\0")
        yield int(pair[lo]), int(hi - lo), int(t.sum()), planes


def _rows(columns: dict[str, list]) -> pa.RecordBatch:
    types = {"pos": pa.int32(), "a": pa.int32(), "b": pa.int32(), "groups_sha256": pa.string(),
             "planes": pa.list_(pa.binary())}
    names = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(c, [None] * n), types.get(c, pa.int64())) for c in names], names)


def build_index(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Two kinds of rows, staged: a document (chunk, pos, doc_id, its digest; ``a`` is
    null), and a pair's postings in a chunk (a, b, counts, planes; ``pos`` is null)."""
    ship(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a_path, b_path)
        chunk = TaskContext.get().partitionId() << 32
        links: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        taken = n_links = 0

        def postings() -> Iterator[pa.RecordBatch]:
            rows = list(chunk_bitmaps(links, owners)) if links else []
            for at in range(0, len(rows), 4096):
                pair, n_docs, n, planes = zip(*rows[at:at + 4096])
                yield _rows({"chunk": [chunk] * len(pair), "a": [p >> 32 for p in pair],
                             "b": [p & 0xFFFFFFFF for p in pair], "n_docs": n_docs, "n_links": n,
                             "planes": planes})

        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_DOCS):
                part = whole.slice(at, SLICE_DOCS)
                digests = {c: [] for c in ("chunk", "pos", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")}
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc_id, parts in zip(part.column(0).to_pylist(), aligner.align(texts)):
                    if taken == CHUNK_DOCS or n_links >= CHUNK_LINKS:
                        yield from postings()
                        chunk, taken, n_links = chunk + 1, 0, 0
                        links.clear()
                        owners.clear()
                    row = (chunk, taken, doc_id, 0, 0, 0, "")
                    if parts:
                        n_a, n_b, n, groups, pairs = zip(*parts)
                        n = sum(n)
                        row = (chunk, taken, doc_id, sum(n_a), sum(n_b), n,
                               hashlib.sha256(b";".join(groups)).hexdigest())
                        links.append(np.frombuffer(b"".join(pairs), np.int64))
                        owners.append(np.full(n, taken, np.int64))
                        n_links += n
                    taken += 1
                    for c, v in zip(digests, row):
                        digests[c].append(v)
                yield _rows(digests)
        yield from postings()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.mapInArrow(run, INDEX_SCHEMA), "align-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """(a, b, pair_docs, pair_links, best): corpus-wide popcounts of every linked pair;
    ``best``: no other pair of this b has more links."""
    pairs = index.filter("a IS NOT NULL").groupBy("a", "b").agg(
        F.sum("n_docs").alias("pair_docs"), F.sum("n_links").alias("pair_links"))
    pairs = stage(pairs, "align-pairs")
    most = pairs.groupBy(F.col("b").alias("m_b")).agg(F.max("pair_links").alias("most"))
    return (pairs.join(most, F.col("b") == F.col("m_b"))
            .select("a", "b", "pair_docs", "pair_links", (F.col("pair_links") == F.col("most")).alias("best")))


def document_scores(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """(chunk, pos, n_links, n_best, count_sum) of every document with links."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros((3, 1 << 16), np.int64)

        def scores() -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(sums[0])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), now)), pa.array(at.astype(np.int32)),
                     *[pa.array(s[at]) for s in sums]], ["chunk", "pos", "n_links", "n_best", "count_sum"])

        for batch in batches:
            planes = batch.column(3).to_pylist()
            for chunk, count, best, bitmaps in zip(*(batch.column(k).to_pylist() for k in range(3)), planes):
                if chunk != now:
                    yield from scores()
                    now = chunk
                    sums[:] = 0
                for j, bitmap in enumerate(bitmaps):
                    docs = unpack_bitmap(bitmap)
                    sums[0, docs] += 1 << j
                    if best:
                        sums[1, docs] += 1 << j
                    sums[2, docs] += count << j
        yield from scores()

    postings = (index.filter("a IS NOT NULL").select("chunk", "a", "b", "planes")
                .join(pairs.select("a", "b", "pair_links", "best"), ["a", "b"])
                .select("chunk", "pair_links", "best", "planes")
                .repartition("chunk").sortWithinPartitions("chunk"))
    return postings.mapInArrow(run, "chunk long, pos int, n_links long, n_best long, count_sum long")


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Of every document its numbers of tokens, groups and links, the digest of its
    groups, and the scores of its links over the whole corpus."""
    index = build_index(docs, a_path, b_path)
    scores = document_scores(index, pair_counts(index))
    whole = index.filter("pos IS NOT NULL").select(
        "chunk", "pos", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_links", "n_best", "count_sum")]
    return whole.join(scores, ["chunk", "pos"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", *zero, "groups_sha256")
