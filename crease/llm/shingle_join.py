"""Jaccard join on word n-grams by a grouped prefix join; components of its links.

A document is the set of its three-word shingles (A-Z lower-cased, words split at
ASCII white space).  Two are linked when 10 times their intersection is at least 9
times their union (``SHARE``).

* **Order.**  Shingles are ordered by how many documents hold them, rare ones first
  (classes of powers of two, then by hash): every task sends its shingle hashes, by
  hash range and as packed numbers, to that range's task, which counts them.  The
  classes come back as one table of ``SLOTS`` bytes, whatever the corpus holds; a slot
  has the highest class of its shingles.  Any order common to all documents is exact.
* **Prefix.**  Linked sets of n shingles share one of their first n // 10 + 1.
  Shingles of slots where nothing occurs twice are left out: nothing can share them.
* **Groups.**  Documents with the same size and the same prefix, at the same places,
  are one group, equal documents among them.  Groups meet in the prefix shingles they
  share; sizes must be in reach, and so must the overlap that the places leave.
* **Hubs.**  A shingle's hub is the group that has it earliest (few shingles of its
  own come before).  All groups of the shingle are expanded and their members verified
  against the hub's first member, as are the members of each group against its own;
  links join components.
* **The rest.**  Groups, split by component, whose filters still allow a link between
  two components are paired, expanded and verified, member by member.

Members of one component are never paired again, so a circle of look-alikes costs a
row a member; what two components may share has passed both filters.  Comparisons
are dealt by hub and salt, texts go to comparisons only.  Hashes have 64 bits.

Edge cases: fewer than three words are one shingle; null, empty and wordless texts are
linked with nothing, not even each other; repeated rows are linked documents; a null
doc_id takes part and names no component but its own; an empty table gives no rows;
other columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.common import hash_bitmap, ship, split_by_bitmap, stage
from crease.llm.near_dup import _dealt, _mix, components, text_node

WORDS = 3
SHARE = (9, 10)              # intersection and union of the least similar linked sets
SLOT_BITS = 24               # of the table of classes: 16 MB
RANGES = 256                 # of hashes at least; tasks that count them
BUFFER = 1 << 21             # shingles that a task sorts at a time
CACHE_WORDS = 1 << 19

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
_WORD_HASH: dict[bytes, bytes] = {}                # per worker process


def shingle_set(text: bytes | None) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    words = (text or b"").lower().split()          # bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, _U)
    if len(_WORD_HASH) > CACHE_WORDS:
        _WORD_HASH.clear()
    get, packed = _WORD_HASH.get, []
    for w in words:
        h = get(w)
        if h is None:
            h = xxhash.xxh3_64_digest(w)
            if len(w) < 64:
                _WORD_HASH[w] = h
        packed.append(h)
    w = np.frombuffer(b"".join(packed), "<u8")
    k = min(WORDS, len(words))
    n = len(words) - k + 1
    h = np.full(n, k, _U)
    for i in range(k):
        h = _mix(h * _GOLDEN + w[i:i + n])
    return np.unique(h)


def _text(docs: DataFrame) -> Column:
    return F.col("text").cast("string").cast("binary").alias("text")


# ------------------------------------------------------------------ frequency classes
def frequency_classes(docs: DataFrame) -> np.ndarray:
    """For each slot (a shingle hash's first ``SLOT_BITS`` bits) the highest class of
    its shingles: the number of binary digits of the documents that hold it, less one."""
    spark = docs.sparkSession
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(16, (max(RANGES, wanted) - 1).bit_length())

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: list[np.ndarray] = []
        held = 0

        def blobs() -> pa.RecordBatch:
            h = np.sort(np.concatenate(sets))
            part = (h >> _U(64 - bits)).astype(np.int64)
            rest = ((h << _U(bits)) >> _U(32)).astype("<u4")      # the next 32 bits
            at = np.searchsorted(part, np.arange((1 << bits) + 1))
            own = np.flatnonzero(np.diff(at))
            return pa.RecordBatch.from_arrays(
                [pa.array(own), pa.array([rest[at[r]:at[r + 1]].tobytes() for r in own], pa.binary())],
                ["part", "rest"])

        for batch in batches:
            for t in batch.column(0):
                sets.append(shingle_set(t.as_py()))
                held += len(sets[-1])
                if held >= BUFFER:
                    yield blobs()
                    sets.clear()
                    held = 0
        if held:
            yield blobs()

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def classes() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            h, n = np.unique(np.frombuffer(b"".join(held), "<u4"), return_counts=True)
            slot = h >> np.uint32(32 - (SLOT_BITS - bits))
            out = np.zeros(1 << (SLOT_BITS - bits), np.uint8)
            np.maximum.at(out, slot, (np.frexp(n)[1] - 1).astype(np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([out.tobytes()], pa.binary())],
                                             ["part", "classes"])

        for batch in batches:
            for part, rest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now:
                    yield from classes()
                    now, held = part, []
                held.append(rest)
        yield from classes()

    sent = docs.select(_text(docs)).mapInArrow(send, "part long, rest binary")
    rows = sent.repartition("part").sortWithinPartitions("part").mapInArrow(
        tally, "part long, classes binary")
    table = np.zeros(1 << SLOT_BITS, np.uint8)
    width = 1 << (SLOT_BITS - bits)
    for r in rows.collect():                       # SLOTS bytes in all, whatever the corpus holds
        table[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(r["classes"], np.uint8)
    return table


# ------------------------------------------------------------------ prefixes and groups
def prefix_of(shingles: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, places) of the prefix that other documents may share."""
    of = classes[(shingles >> _U(64 - SLOT_BITS)).astype(np.int64)]
    k = len(shingles) - -(-SHARE[0] * len(shingles) // SHARE[1]) + 1
    first = np.lexsort((shingles, of))[:k]
    places = np.flatnonzero(of[first] > 0)
    return shingles[first[places]], places


def grouped_prefixes(docs: DataFrame, classes: np.ndarray) -> DataFrame:
    """doc_id, key (names equal texts), n_shingles, node (names equal sets), gid (names
    equal sizes and prefixes) and the prefix; node is null for documents without
    shingles, gid for documents that share none of theirs."""
    table = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                sizes, nodes, gids, tokens, places = [], [], [], [], []
                for t in batch.column(2):
                    s = shingle_set(t.as_py())
                    sizes.append(len(s))
                    nodes.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    token, place = prefix_of(s, table.value) if len(s) else (s, np.zeros(0, np.int64))
                    tokens.append(token.view(np.int64))
                    places.append(place)
                    gids.append(hashlib.md5(b"%d," % len(s) + token.tobytes() + place.astype("<i8").tobytes())
                                .digest() if len(token) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                     pa.array(gids, pa.binary()), pa.array(tokens, pa.list_(pa.int64())),
                     pa.array(places, pa.list_(pa.int64()))],
                    ["doc_id", "key", "n_shingles", "node", "gid", "tokens", "places"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_node().alias("key"), _text(docs)).mapInArrow(
        run, "doc_id long, key binary, n_shingles long, node binary, gid binary, "
             "tokens array<long>, places array<long>")


def node_texts(docs: DataFrame, rows: DataFrame, members: DataFrame) -> DataFrame:
    """(node, text) of every member, once each."""
    wanted = stage(rows.join(members.select("node").distinct(), "node").groupBy("node")
                   .agg(F.min("key").alias("key")), "ngram-wanted")
    likely, _ = split_by_bitmap(docs.select(text_node().alias("key"), _text(docs)), F.xxhash64("key"),
                                hash_bitmap(wanted, F.xxhash64("key")))
    return likely.join(wanted, "key").dropDuplicates(["key"]).select("node", "text")


def shared_postings(rows: DataFrame) -> DataFrame:
    """(token, gid, place, size), once each, of the prefix shingles that several groups hold."""
    spread = rows.filter("gid IS NOT NULL").select(
        "gid", F.xxhash64("gid").alias("h"), F.col("n_shingles").alias("size"),
        F.explode(F.arrays_zip("tokens", "places")).alias("p")).select(
        "gid", "h", "size", F.col("p.tokens").alias("token"), F.col("p.places").alias("place"))
    several = stage(spread.groupBy("token").agg(F.min("h").alias("a"), F.max("h").alias("b"))
                    .filter("a < b").select("token"), "ngram-tokens")
    likely, _ = split_by_bitmap(spread.drop("h"), F.xxhash64("token"), hash_bitmap(several, F.xxhash64("token")))
    return likely.join(several, "token").select("token", "gid", "place", "size").distinct()


# ------------------------------------------------------------------ verification
def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (hub, node) whose sets are similar enough, staged."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = np.zeros(0, _U)
        for batch in batches:
            hubs, nodes = [], []
            for hub, node, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                own = shingle_set(text.as_py())
                if node is None:
                    head = own
                    continue
                both = len(np.intersect1d(head, own, assume_unique=True))
                if SHARE[1] * both >= SHARE[0] * (len(head) + len(own) - both):
                    hubs.append(hub)
                    nodes.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.binary()), pa.array(nodes, pa.binary())],
                                             ["hub", "node"])

    return stage(_dealt(pairs, texts).mapInArrow(run, "hub binary, node binary"), "ngram-links")


def in_reach(x: str, y: str) -> Column:
    """Sizes and places (columns ``<x>size``, ``<x>place``) leave the overlap that a link needs."""
    sizes = F.col(f"{x}size") + F.col(f"{y}size")
    left = F.least(F.col(f"{x}size") - F.col(f"{x}place"), F.col(f"{y}size") - F.col(f"{y}place"))
    return (sum(SHARE) * left >= SHARE[0] * sizes) & (
        SHARE[1] * F.least(f"{x}size", f"{y}size") >= SHARE[0] * F.greatest(f"{x}size", f"{y}size"))


def hub_pairs(postings: DataFrame, members: DataFrame) -> DataFrame:
    """(hub, node): the members of a shingle's groups, and of a group, each with the
    first member of the hub."""
    first = members.groupBy("gid").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
    best = postings.groupBy("token").agg(F.min(F.struct("place", "size", "gid")).alias("h"))
    near = (postings.join(best.select("token", F.col("h.place").alias("h_place"), F.col("h.size").alias("h_size"),
                                      F.col("h.gid").alias("h_gid")), "token")
            .filter(F.col("gid") != F.col("h_gid")).filter(in_reach("", "h_"))
            .select("h_gid", "gid").distinct())
    within = first.filter("hub < last").select(F.col("gid").alias("h_gid"), "gid")
    heads = first.select(F.col("gid").alias("h_gid"), "hub")
    return (near.unionByName(within).join(heads, "h_gid").join(members, "gid")
            .filter("hub <> node").select("hub", "node").distinct())


def open_pairs(postings: DataFrame, members: DataFrame, labels: DataFrame) -> DataFrame:
    """(hub, node) of different components that the filters still allow to be linked."""
    labelled = stage(members.join(labels, "node", "left").select(
        "gid", "node", F.coalesce("label", "node").alias("label")), "ngram-labelled")
    parts = labelled.select("gid", "label").distinct()
    rows = postings.join(parts, "gid")
    several = (rows.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b"))
               .filter("a < b").select("token"))
    rows = stage(rows.join(several, "token"), "ngram-open")
    sides = [rows.select("token", *[F.col(c).alias(f"{s}{c}") for c in ("gid", "label", "place", "size")])
             for s in "xy"]
    pairs = (sides[0].join(sides[1], "token").filter(F.col("xlabel") < F.col("ylabel")).filter(in_reach("x", "y"))
             .select("xgid", "xlabel", "ygid", "ylabel").distinct())
    # two components inside one group need no shared shingle of several groups
    several = parts.groupBy("gid").agg(F.min("label").alias("a"), F.max("label").alias("b")).filter("a < b")
    split = parts.join(several.select("gid"), "gid")
    inside = (split.select(F.col("gid").alias("xgid"), F.col("label").alias("xlabel"))
              .join(split.select(F.col("gid").alias("ygid"), F.col("label").alias("ylabel")),
                    (F.col("xgid") == F.col("ygid")) & (F.col("xlabel") < F.col("ylabel")))
              .select("xgid", "xlabel", "ygid", "ylabel"))
    expand = [labelled.select(F.col("gid").alias(f"{s}gid"), F.col("label").alias(f"{s}label"),
                              F.col("node").alias(n)) for s, n in (("x", "hub"), ("y", "node"))]
    return (pairs.unionByName(inside).distinct().join(expand[0], ["xgid", "xlabel"])
            .join(expand[1], ["ygid", "ylabel"]).select("hub", "node").distinct())


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of
    every document."""
    ship(docs.sparkSession)
    rows = stage(grouped_prefixes(docs, frequency_classes(docs)), "ngram-prefixes")
    postings = stage(shared_postings(rows), "ngram-postings")
    grouped = rows.filter("gid IS NOT NULL").select("gid", "node").distinct()
    several = grouped.groupBy("gid").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b")
    meet = postings.select("gid").union(several.select("gid")).distinct()
    members = stage(grouped.join(meet, "gid"), "ngram-members")
    pairs = stage(hub_pairs(postings, members), "ngram-pairs")
    texts = stage(node_texts(docs, rows, members), "ngram-texts")
    links = linked(pairs, texts)
    labels = components(links)
    rest = stage(open_pairs(postings, members, labels).join(pairs, ["hub", "node"], "left_anti"), "ngram-rest")
    found = linked(rest, texts)
    if not found.isEmpty():
        labels = components(links.unionByName(found))
    own = rows.select("doc_id", "n_shingles", "node").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    least = own.filter("node IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return (own.join(least, "label", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")))
