"""Near-duplicate classes by BagMinHash over weighted word shingles.

A document is the multiset of its five-word shingles (words split at white space,
lower case); similarity is the weighted Jaccard of the multisets.

* **Signatures (BagMinHash).**  A shingle of weight w owns the weight axis [0, w),
  discretised in octaves [0,1), [1,2), [2,4), ...  Every (shingle, octave) has one
  Poisson process, the same in all documents, with a rate in proportion to the
  octave's width; a point carries a register and a place in the octave.  Octaves
  below w count in full, of the last one only points below w: a hierarchy that
  costs log w, not w.  A register keeps its earliest point; two signatures agree in
  a register with a probability of the weighted Jaccard similarity.  Points are
  drawn up to a time by which all registers are filled as a rule, and up to twice
  that time for documents where one is not, so that nothing is approximated.
* **Nodes.**  Documents with equal texts are one node.
* **Bands.**  ``ROWS`` registers a band; nodes that agree in a band share a bucket.
* **Verification by hubs.**  A bucket never emits all its pairs.  Its hub -- the
  member that shares the most buckets with others, the original of a group of
  edited copies as a rule -- is compared with each member, on whole multisets, and
  links join components.
* **The rest by prefix filtering.**  In buckets that still hold several components,
  two members of one hub's circle can only be alike if they share a token among their
  first ones, tokens that the hub lacks first, and early enough for the overlap they
  need; few pairs do, and those are compared.
* **Classes.**  Connected components of the links; the smallest doc_id names one.

Skew: hubs and counts are map-side aggregates; comparisons are dealt by hub and a
salt that grows with the hub's members, the hub's text going to every salt; texts
travel only for nodes in comparisons, once a comparison.

Edge cases: a text of one to four words is one shingle; null texts and texts
without words are like nothing, each its own class; repeated rows are documents of
one node; a null doc_id takes part, and names a class only when no other member
has one; an empty table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crease.llm.common import delete_all, hash_bitmap, own_columns, ship, split_by_bitmap, stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 26
ROWS = 5
SALT_ROWS = 512              # comparisons of one hub in one group
EARLIER = 8                  # tokens before a token that its row carries
CACHE_WORDS = 1 << 17        # words a worker remembers, 25 MB at most, before it starts afresh

_U = np.uint64
_GOLDEN, _M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_WORD_HASH: dict[str, bytes] = {}                  # per worker process


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (fixed values: its published constants)."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _hashes(words: list[str]) -> np.ndarray:
    if len(_WORD_HASH) > CACHE_WORDS:
        _WORD_HASH.clear()
    get, out = _WORD_HASH.get, []
    for w in words:
        h = get(w)
        if h is None:
            h = xxhash.xxh3_64_digest(w.encode("utf-8", "surrogatepass"))
            if len(w) < 64:
                _WORD_HASH[w] = h
        out.append(h)
    return np.frombuffer(b"".join(out), "<u8")


def shingles(words: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes, ascending, and their weights."""
    if not words:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    w = _hashes(words)
    n = max(1, len(words) - size + 1)
    h = np.full(n, len(words) if len(words) < size else size, _U)
    for k in range(min(size, len(words))):
        h = _mix(h * _GOLDEN + w[k:k + n])
    return np.unique(h, return_counts=True)


def bag_minhash(keys: np.ndarray, weights: np.ndarray, owner: np.ndarray, n_docs: int,
                registers: int = BANDS * ROWS) -> np.ndarray:
    """Signatures of ``n_docs`` weighted sets, one row each (zeros for empty sets).

    ``owner`` gives the set of each key.  The value of a register is a hash of the
    point that came first.
    """
    total = np.bincount(owner, weights, n_docs)
    value = np.zeros((n_docs, registers), _U)
    # (shingle, octave) processes: octave 0 is [0, 1), octave j is [2^(j-1), 2^j)
    top = np.frexp(weights - 1.0)[1] + 1            # octaves up to the one that holds the weight's end
    rep = np.repeat(np.arange(len(keys)), top)
    octave = np.arange(len(rep)) - np.repeat(np.cumsum(top) - top, top)
    low = np.where(octave == 0, 0, 1 << np.maximum(octave - 1, 0))
    rate = registers * np.maximum(low, 1)
    upto = (weights[rep] - low) / np.maximum(low, 1)           # share of the octave below w
    seed = _mix(keys[rep] + _GOLDEN * (octave.astype(_U) + _U(1)))
    own = owner[rep]
    with np.errstate(divide="ignore"):
        until = (np.log(registers) + 3) / total
    open_docs = total > 0
    while open_docs.any():
        times, places, points = [], [], []
        live = np.flatnonzero(open_docs[own])
        t = np.zeros(len(live))
        step = 0
        while len(live):
            step += 3
            s = seed[live]
            t = t - np.log1p(-_unit(s, step)) / rate[live]
            near = np.flatnonzero(t <= until[own[live]])
            live, t, s = live[near], t[near], s[near]
            bits = _mix(s + _offset(step + 1))
            hit = upto[live] >= 1
            part = np.flatnonzero(~hit)
            hit[part] = _unit(s[part], step + 2) < upto[live[part]]
            times.append(t[hit])
            points.append(bits[hit])
            places.append(own[live[hit]] * registers + (bits[hit] >> _U(8)).astype(np.int64) % registers)
        first = np.zeros(n_docs * registers, _U)
        filled = np.zeros(n_docs * registers, bool)
        t, at, bits = map(np.concatenate, (times, places, points))
        late_first = np.argsort(-t, kind="stable")
        first[at[late_first]] = bits[late_first]                # the last write, the earliest point, stays
        filled[at] = True
        done = open_docs & filled.reshape(n_docs, registers).all(axis=1)
        value[done] = first.reshape(n_docs, registers)[done]
        open_docs &= ~done
        until = until * 2
    return value


def _offset(step: int) -> np.uint64:
    return _U(step * int(_GOLDEN) % 2 ** 64)


def _unit(seed: np.ndarray, step: int) -> np.ndarray:
    """Uniform numbers of [0, 1), one for each seed and step."""
    return (_mix(seed + _offset(step)) >> _U(11)).astype(float) * 2.0 ** -53


def band_hashes(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket number for every band of every signature."""
    part = signatures.reshape(len(signatures), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), part.shape[:2])
    for k in range(rows):
        h = _mix(h * _GOLDEN + part[:, :, k])
    return h.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    whole = int(a[1].sum() + b[1].sum()) - both
    return both / whole if whole else 0.0


# ------------------------------------------------------------------ jobs
def text_node() -> Column:
    """128 bits that name a text; documents with equal texts are one node."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, node and bucket numbers of every document (none without words)."""
    ship(docs.sparkSession)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, 500):
                part = whole.slice(at, 500)
                sets = [shingles(words_of(t.as_py())) for t in part.column(2)]
                owner = np.repeat(np.arange(len(sets)), [len(k) for k, _ in sets])
                signatures = bag_minhash(
                    np.concatenate([k for k, _ in sets]), np.concatenate([w for _, w in sets]),
                    owner, len(sets), bands * rows)
                buckets = band_hashes(signatures, bands, rows)
                full = [len(k) > 0 for k, _ in sets]
                lists = pa.array([b if f else [] for b, f in zip(buckets, full)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists],
                                                 ["doc_id", "node", "buckets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_node().alias("node"), "text"
                       ).mapInArrow(run, "doc_id long, node binary, buckets array<long>")


def shared_buckets(sketches: DataFrame, gone: list[str] | None = None) -> DataFrame:
    """(bucket, node), once each, of the buckets that hold different nodes."""
    rows = sketches.select("node", F.xxhash64("node").alias("h"), F.explode("buckets").alias("bucket"))
    done: list[str] = []
    many = stage(rows.groupBy("bucket").agg(F.min("h").alias("a"), F.max("h").alias("b"))
                 .filter("a < b").select("bucket"), "near-buckets", done)
    likely, _ = split_by_bitmap(rows, F.xxhash64("bucket"), hash_bitmap(many, F.xxhash64("bucket")))
    members = stage(likely.join(many, "bucket").select("bucket", "node").distinct(), "near-members", gone)
    delete_all(sketches.sparkSession, done)
    return members


def hubs(members: DataFrame) -> DataFrame:
    """(bucket, hub): of each bucket the member that meets the most others in all
    its buckets; ties go to the smallest node."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    score = members.join(sizes, "bucket").groupBy("node").agg(F.sum("n").alias("score"))
    return (members.join(score, "node").groupBy("bucket")
            .agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("node").alias("hub"))).alias("m"))
            .select("bucket", "m.hub"))


def _dealt(pairs: DataFrame, texts: DataFrame, gone: list[str] | None = None) -> DataFrame:
    """Texts of pairs, dealt by hub and salt, each group's hub first (node null)."""
    n = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).alias("salts"))
    salted = stage(pairs.join(n, "hub")
                   .select("hub", "node", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt")),
                   "near-salted", gone)
    t = texts.select(F.col("node").alias("t_node"), "text")
    members = salted.join(t, F.col("node") == F.col("t_node")).select("hub", "salt", "node", "text")
    heads = (salted.select("hub", "salt").distinct().join(t, F.col("hub") == F.col("t_node"))
             .select("hub", "salt", F.lit(None).cast("binary").alias("node"), "text"))
    return (heads.unionByName(members).repartition("hub", "salt")
            .sortWithinPartitions("hub", "salt", F.col("node").asc_nulls_first()))


def _groups(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, tuple, bytes, tuple]]:
    """(hub, its shingles, node, its shingles), one comparison after another."""
    head: tuple = ()
    for part in parts:
        hub, node, text = part.column(0).to_pylist(), part.column(2).to_pylist(), part.column(3)
        for h, n, t in zip(hub, node, text):
            own = shingles(words_of(t.as_py()))
            if n is None:
                head = own
            else:
                yield h, head, n, own


def compare(pairs: DataFrame, texts: DataFrame, gone: list[str] | None = None) -> DataFrame:
    """(hub, node, similarity) of every pair, staged."""
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(h, n, weighted_jaccard(a, b)) for h, a, n, b in _groups(parts)]
        cols = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()),
             pa.array(cols[2], pa.float64())], ["hub", "node", "similarity"])

    done: list[str] = []
    compared = stage(_dealt(pairs, texts, done).mapInArrow(
        run, "hub binary, node binary, similarity double"), "near-compared", gone)
    delete_all(pairs.sparkSession, done)
    return compared


def rare_first_prefixes(pairs: DataFrame, texts: DataFrame, similarity: float = SIMILARITY,
                        gone: list[str] | None = None) -> DataFrame:
    """(bucket, node, pos, size, own, before): the first tokens of each member of a hub's
    circle, and how many of its tokens the hub lacks (``own``).

    Two members with a similarity s share a token among the first n - ceil(s n) + 1
    of their n tokens, in any order common to both.  The order here puts tokens
    that the hub lacks first: members that resemble each other only in what they
    share with the hub hardly meet any more.  ``before`` are the ``EARLIER`` tokens
    before at most, so that a row's size is bounded whatever the text's length.
    """
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for h, a, n, b in _groups(parts):
            size = int(b[1].sum())
            # tokens: the shingle's first copy, second copy, ...
            copy = np.arange(size) - np.repeat(np.cumsum(b[1]) - b[1], b[1])
            token = np.repeat(b[0], b[1])
            _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
            have = np.zeros(len(b[0]), np.int64)
            have[j] = a[1][i]
            in_hub = copy < np.repeat(have, b[1])
            token = _mix(token + _GOLDEN * (copy.astype(_U) + _U(1)))
            order = np.lexsort((token, in_hub))
            first = token[order[:size - int(np.ceil(similarity * size - 1e-9)) + 1]]
            bucket = _mix(first + np.frombuffer(h[:8], "<u8")).view(np.int64)
            k = len(bucket)
            carried = np.minimum(np.arange(k), EARLIER)
            ends = np.cumsum(carried)
            at = np.arange(ends[-1]) + np.repeat(np.arange(k) - ends, carried)
            befores = pa.ListArray.from_arrays(
                np.concatenate([[0], ends]).astype(np.int32), pa.array(bucket[at]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array([n] * k, pa.binary()), pa.array(np.arange(k)),
                 pa.array(np.full(k, size)), pa.array(np.full(k, size - int(in_hub.sum()))), befores],
                ["bucket", "node", "pos", "size", "own", "before"])

    done: list[str] = []
    tokens = stage(_dealt(pairs, texts, done).mapInArrow(
        run, "bucket long, node binary, pos long, size long, own long, before array<long>"), "near-tokens", gone)
    delete_all(pairs.sparkSession, done)
    return tokens


def prefix_pairs(tokens: DataFrame, labels: DataFrame, similarity: float = SIMILARITY,
                 gone: list[str] | None = None) -> DataFrame:
    """(hub, node): members of different components that may still be alike.

    What follows a common token must leave room for the overlap that the similarity
    asks for, which few pairs reach: of the tokens that the hub lacks, two members can
    share what either has left of them, and of the hub's own what the poorer one has.
    A pair that has room at any common token has it
    at its first one, and a distinct leaves one row a pair.  The tokens just before only
    save rows: a pair that shares one of them has met there already.  Tables without
    ``own`` tell nothing of the hub: all tokens count as those it lacks.
    """
    if "own" not in tokens.columns:
        tokens = tokens.withColumn("own", F.col("size"))
    rows = stage(_open(tokens, labels), "near-open", gone)
    columns = ("node", "label", "pos", "size", "own", "before")
    x, y = (rows.select("bucket", *[F.col(c).alias(f"{s}_{c}") for c in columns]) for s in "xy")
    room = (F.greatest(F.lit(0), F.least(*[F.col(f"{s}_own") - F.col(f"{s}_pos") for s in "xy"]))
            + F.least(*[F.col(f"{s}_size") - F.greatest(f"{s}_own", f"{s}_pos") for s in "xy"]))
    least = similarity / (1 + similarity) * (F.col("x_size") + F.col("y_size")) - 1e-6
    return (x.join(y, (x["bucket"] == y["bucket"]) & (F.col("x_node") < F.col("y_node"))
                   & (room >= least) & (F.col("x_label") != F.col("y_label")) & ~F.arrays_overlap("x_before", "y_before"))
            .select(F.col("x_node").alias("hub"), F.col("y_node").alias("node")).distinct())


def _digest(edges: DataFrame) -> tuple:
    """The same for equal sets of distinct edges."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h), F.sum(h * h % 1000003)).first())


def components(links: DataFrame, gone: list[str] | None = None) -> DataFrame:
    """(node, label): connected components of (hub, node) links, the smallest node
    as label, by large-star and small-star steps until nothing changes."""
    done: list[str] = []
    edges = stage(links.select(F.greatest("hub", "node").alias("u"), F.least("hub", "node").alias("v"))
                  .filter("u <> v").distinct(), "near-edges", done)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stage(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .filter("u <> v").distinct(), "near-large", done)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        last: list[str] = []
        small = stage(large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u"))
                                                  .otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
                      .unionByName(low.select("u", F.col("m").alias("v")))
                      .filter("u <> v").distinct(), "near-small", last)
        same = _digest(edges) == _digest(small)
        delete_all(links.sparkSession, done)
        if same:
            if gone is not None:
                gone += last
            return small.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
                small.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
        edges, done = small, last


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return (members.join(labels, "node", "left")
            .withColumn("label", F.coalesce("label", "node")))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, label) of the buckets that hold several components."""
    rows = _labelled(members, labels)
    several = (rows.withColumn("h", F.xxhash64("label")).groupBy("bucket")
               .agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a < b").select("bucket"))
    return rows.join(several, "bucket")


def near_links(docs: DataFrame, sketches: DataFrame, similarity: float = SIMILARITY,
               kept: list[str] | None = None) -> DataFrame:
    """(node, label) of every node that is like another one, staged (its path goes to
    ``kept``); the tables on the way are deleted."""
    gone: list[str] = []
    members = shared_buckets(sketches, gone)
    wanted = stage(members.select("node").distinct(), "near-wanted", gone)
    likely, _ = split_by_bitmap(docs.select(text_node().alias("node"), "text"), F.xxhash64("node"),
                                hash_bitmap(wanted, F.xxhash64("node")))
    texts = stage(likely.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "near-texts", gone)
    # the buckets of the bands: every member against its hub
    hub = stage(members.join(hubs(members), "bucket").filter("node <> hub"), "near-hubs", gone)
    tested = compare(hub.select("hub", "node").distinct(), texts, gone)
    links = tested.filter(F.col("similarity") >= similarity).select("hub", "node")
    labels = components(links, gone)
    # what may still join two components: members of one hub's circle.  1 - similarity
    # is a distance; a member linked to the hub is in reach of an unlinked one only
    # if their distances from the hub differ by 1 - similarity at most
    circle = (_open(hub.select("bucket", "node", "hub"), labels).select("hub", "node").distinct()
              .join(tested, ["hub", "node"]))
    nearest = circle.groupBy("hub").agg(
        F.max(F.when(F.col("similarity") < similarity, F.col("similarity"))).alias("near"))
    circle = stage(circle.join(nearest, "hub").filter(
        (F.col("similarity") < similarity)
        | (F.col("near") >= F.col("similarity") - (1 - similarity) - 1e-9)).select("hub", "node"), "near-circles", gone)
    tokens = rare_first_prefixes(circle, texts, similarity, gone)
    pairs = prefix_pairs(tokens, labels, similarity, gone)
    more = compare(stage(pairs.join(tested.select("hub", "node"), ["hub", "node"], "left_anti"),
                         "near-pairs", gone), texts, gone)
    found = more.filter(F.col("similarity") >= similarity).select("hub", "node")
    if not found.isEmpty():
        labels = components(links.unionByName(found), gone)
    labels = stage(labels, "near-labels", kept)
    delete_all(docs.sparkSession, gone)
    return labels


def labelled(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node, worded and label (the smallest node of the class) of every document."""
    gone: list[str] = []
    sketches = stage(sketch(docs), "near-sketches", gone)
    labels = near_links(docs, sketches, similarity, gone)
    rows = stage(sketches.select("doc_id", "node", (F.size("buckets") > 0).alias("worded"))
                 .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "near-labelled")
    delete_all(docs.sparkSession, gone)
    return rows


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, node and class_id (the smallest doc_id of the class) of every document.

    Documents without words are classes of their own.
    """
    rows = labelled(docs, similarity)
    least = rows.filter("worded").groupBy("label").agg(F.min("doc_id").alias("least"))
    return (rows.join(least, "label", "left")
            .select("doc_id", "node", F.when(F.col("worded"), F.col("least"))
                    .otherwise(F.col("doc_id")).alias("class_id")))


def one_per_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns as they came: the smallest doc_id's
    (of equal ids the smallest text hash's; of equal rows any one).  Documents without
    words all stay."""
    # classes go by their label, for ids may be repeated or null
    classes = stage(labelled(docs, similarity).filter("worded")
                    .select("doc_id", F.col("node").alias("d_node"), "label"), "near-classes")
    best = classes.groupBy("label").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "d_node")).alias("b"))
    keep = stage(best.select(F.col("b.doc_id").alias("k_id"), F.col("b.d_node").alias("k_node")), "near-keep")
    of = [F.col("doc_id").eqNullSafe(F.col("k_id")), F.col("d_node") == F.col("k_node")]
    times = classes.groupBy("doc_id", "d_node").agg(F.count(F.lit(1)).alias("n"))
    # documents to drop, and documents that come more than once: all others stay as they are
    doubtful = stage(times.join(keep, of, "left")
                     .select("doc_id", "d_node", F.col("k_node").isNotNull().alias("kept"), "n")
                     .filter("NOT kept OR n > 1"), "near-doubtful")
    rows = docs.select(F.struct(*own_columns(docs)).alias("d_row"), F.col("doc_id").cast("long").alias("d_id"),
                       text_node().alias("d_node"))
    likely, sure = split_by_bitmap(rows, F.xxhash64("d_id", "d_node"),
                                   hash_bitmap(doubtful, F.xxhash64("doc_id", "d_node")))
    what = doubtful.select(F.col("doc_id").alias("k_id"), F.col("d_node").alias("k_node"), "kept")
    judged = likely.join(what, F.col("d_id").eqNullSafe(F.col("k_id"))
                         & (F.col("d_node") == F.col("k_node")), "left")
    return (sure.select("d_row")
            .unionByName(judged.filter("kept IS NULL").select("d_row"))
            .unionByName(judged.filter("kept").dropDuplicates(["d_id", "d_node"]).select("d_row"))
            .select("d_row.*"))
