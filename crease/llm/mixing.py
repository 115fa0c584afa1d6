"""Mixing sources to target weights with Sainte-Lague apportionment.

1. Sizes (words) are summed by source.  Sources in code-point order, null last,
   weigh 3, 1, 2, repeating, and share 150 % of all words; a target stops at
   twice its source's size, and the excess is shared again by weight.
2. A source's documents are dealt to shards of about ``SHARD_WORDS`` words by a
   seeded hash, and a shard's words -- its documents in seeded order -- are cut
   into equal blocks of about ``BLOCK_WORDS`` words, or of a ``FEWEST_BLOCKS``-th of
   the smallest source if that is less (one word at least), so that tiny sources
   come near their targets, too.
3. The blocks of the whole mix go to the sources by highest quotients
   (size / 1, 3, 5, ...: Sainte-Lague), and a source's blocks to its shards in
   the same way: an integer quota for every shard, never more than twice its
   blocks.
4. A shard takes its quota of blocks from a seeded block on, around its end and,
   for the second pass, on again.  Blocks side by side share documents, so hardly
   any document is taken in part.

A document's ``taken`` is what the taken blocks hold of its words, repeats
counted.  The driver sees one row a source (the mix's own specification).  A hot
source is spread over its shards; nothing larger than a shard is ordered in one
task, and nothing larger than a source's list of shards is ranked in one.

Edge cases: a null text has size 0 and takes 0; a null source is a source of its
own, the last; repeated rows are documents of their own (rows that agree in every
column that orders them may swap places, which changes nothing); an empty table
gives no rows; a corpus without words takes nothing.
"""
from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import (WORD, free_name, hash_bitmap, map_arrow, n_words, own_columns, row_hash,
                               ship, split_by_bitmap, stage)

WEIGHTS = (3, 1, 2)
SHARE = 1.5                  # of all words
MOST = 2                     # times a source, a shard, a document
BLOCK_WORDS = 16
FEWEST_BLOCKS = 128          # of the smallest source, where it has that many words
SHARD_WORDS = 1 << 20
SALT_ROWS = 1024             # equal rows that one copy of their text serves
SEED = 20240322

_WORD = re.compile(WORD)


def targets(sizes: list[int], weights: list[float], total: float, most: float = MOST) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size."""
    out = [0.0] * len(sizes)
    open_, left = [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        level = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * level >= most * sizes[i]]
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else weights[i] * level
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2 n + 1), at most ``most`` each.

    Rounded ideal shares are within a few seats of the answer; single seats then
    move by the quotients that give or take them.  Ties go to the earlier entry.
    """
    whole = sum(votes)
    if not whole or seats <= 0:
        return [0] * len(votes)
    got = [min(m, int(v * seats / whole + 0.5)) for v, m in zip(votes, most)]
    seats, given = min(seats, sum(m for v, m in zip(votes, most) if v > 0)), sum(got)
    give = [(-v / (2 * n + 1), i) for i, (v, n, m) in enumerate(zip(votes, got, most)) if n < m]
    heapq.heapify(give)
    for _ in range(seats - given):
        _, i = heapq.heappop(give)
        got[i] += 1
        if got[i] < most[i]:
            heapq.heappush(give, (-votes[i] / (2 * got[i] + 1), i))
    take = [(v / (2 * n - 1), -i) for i, (v, n) in enumerate(zip(votes, got)) if n > 0]
    heapq.heapify(take)
    for _ in range(given - seats):
        _, i = heapq.heappop(take)
        i = -i
        got[i] -= 1
        if got[i]:
            heapq.heappush(take, (votes[i] / (2 * got[i] - 1), -i))
    return got


def _source_table(sized: DataFrame, weights, share: float) -> DataFrame:
    """One row a source: number, size, target, shards and block quota."""
    rows = sized.groupBy("m_source").agg(F.sum("m_size").alias("n")).collect()
    rows = sorted(((r[0], int(r[1])) for r in rows), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [n for _, n in rows]
    total = share * sum(sizes)
    target = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], total)
    smallest = min((n for n in sizes if n), default=0)
    block = max(1, min(BLOCK_WORDS, smallest // FEWEST_BLOCKS))
    blocks = [-(-n // block) for n in sizes]
    quota = sainte_lague(target, round(sum(target) / block), [MOST * b for b in blocks])
    out = [(s, i, n, t, max(1, -(-n // SHARD_WORDS)), q, block)
           for i, ((s, n), t, q) in enumerate(zip(rows, target, quota))]
    return sized.sparkSession.createDataFrame(
        out, "s_source string, s_no int, s_size long, s_target double, s_shards long, s_quota long, "
             "s_block long")


def _shard_quotas(dealt: DataFrame) -> DataFrame:
    """Blocks and quota of every (source, shard), by highest quotients.

    A shard's rounded share is the start; the next quotients of every shard, as
    many as could be needed, are ranked to give or take the few seats missing.
    """
    cells = (dealt.groupBy("s_no", "m_shard")
             .agg(F.sum("m_size").alias("q_words"), F.first("s_size").alias("s_size"),
                  F.first("s_quota").alias("s_quota"), F.first("s_block").alias("s_block"))
             .filter("q_words > 0")
             .withColumn("q_blocks", F.ceil(F.col("q_words") / F.col("s_block")).cast("long"))
             .withColumn("q_votes", F.col("s_quota") * (F.col("q_words") / F.col("s_size")))
             .withColumn("q_base", F.least(F.floor(F.col("q_votes") + 0.5), MOST * F.col("q_blocks"))))
    source = Window.partitionBy("s_no")
    cells = (cells.withColumn("q_cells", F.count(F.lit(1)).over(source))
             .withColumn("q_diff", F.least("s_quota", F.sum(MOST * F.col("q_blocks")).over(source))
                         - F.sum("q_base").over(source)))
    steps = F.ceil(2 * F.col("q_votes") * F.col("q_cells") / F.greatest(F.lit(1), F.col("s_quota"))) + 2
    k = F.col("q_step")
    tried = (cells.filter("q_diff <> 0")
             .select("s_no", "m_shard", "q_votes", "q_base", "q_blocks", "q_diff",
                     F.explode(F.sequence(F.lit(1), steps.cast("long"))).alias("q_step"))
             .withColumn("q_seat", F.when(F.col("q_diff") > 0, F.col("q_base") + k)
                         .otherwise(F.col("q_base") - k + 1))
             .filter(F.col("q_seat").between(1, MOST * F.col("q_blocks")))
             .withColumn("q_quotient", F.col("q_votes") / (2 * F.col("q_seat") - 1)))
    best = Window.partitionBy("s_no").orderBy(
        F.when(F.col("q_diff") > 0, -F.col("q_quotient")).otherwise(F.col("q_quotient")),
        F.when(F.col("q_diff") > 0, F.col("m_shard")).otherwise(-F.col("m_shard")))
    moved = (tried.withColumn("q_rank", F.row_number().over(best))
             .filter(F.col("q_rank") <= F.abs("q_diff"))
             .groupBy("s_no", "m_shard").agg(F.sum(F.signum("q_diff")).cast("long").alias("q_moved")))
    return (cells.join(moved, ["s_no", "m_shard"], "left")
            .select("s_no", "m_shard", "q_words", "q_blocks",
                    (F.col("q_base") + F.coalesce("q_moved", F.lit(0))).alias("q_quota")))


def mix(docs: DataFrame, size: Column, weights=WEIGHTS, share: float = SHARE,
        seed: int = SEED) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and, for those
    who cut texts, ``take_passes`` (whole passes) and ``take_spans`` (word spans
    [from, to) of the last, partial pass).  Names that clash get a ``_`` more."""
    plain = docs.select(F.struct(*own_columns(docs)).alias("m_row"), size.alias("m_size"),
                        F.col("source").cast("string").alias("m_source"))
    plain = plain.withColumn("m_id", F.col("m_row.doc_id"))
    sized = stage(plain.select("m_size", "m_source", "m_id"), "mix-sizes")
    sources = stage(_source_table(sized, weights, share), "mix-sources")

    def dealt(df: DataFrame) -> DataFrame:
        return (df.join(sources, df.m_source.eqNullSafe(sources.s_source))
                .withColumn("m_shard", F.pmod(F.xxhash64(F.lit(seed), "m_id", "m_size"),
                                              F.col("s_shards"))))

    quotas = stage(_shard_quotas(dealt(sized)), "mix-quotas")
    line = (Window.partitionBy("s_no", "m_shard")
            .orderBy(F.xxhash64(F.lit(seed + 1), "m_id"), "m_id", "m_size", F.xxhash64("m_row"))
            .rowsBetween(Window.unboundedPreceding, -1))
    # the quota: whole passes over the shard, then blocks from a seeded one on
    rows = (dealt(plain).join(quotas, ["s_no", "m_shard"], "left")
            .withColumn("m_at", F.coalesce(F.sum("m_size").over(line), F.lit(0)))
            .withColumn("m_passes", F.coalesce(F.expr("q_quota div q_blocks"), F.lit(0)))
            .withColumn("m_first", F.expr(f"pmod(xxhash64({seed + 2}, s_no, m_shard), q_blocks)"))
            .withColumn("m_last", F.expr("m_first + q_quota % q_blocks")))

    def overlap(first: str, last: str) -> Column:
        """The row's words between two block edges of its shard."""
        edge = "cast(({}) * q_words div q_blocks as bigint) - m_at"
        return F.struct(F.greatest(F.lit(0).cast("long"), F.expr(edge.format(first))).alias("from"),
                        F.least(F.col("m_size"), F.expr(edge.format(last))).alias("to"))

    spans = F.filter(F.array(overlap("0", "greatest(m_last - q_blocks, 0)"),
                             overlap("m_first", "least(m_last, q_blocks)")),
                     lambda s: s["from"] < s["to"])
    rows = rows.withColumn("m_spans", F.coalesce(spans, F.array().cast(
        "array<struct<from:bigint,to:bigint>>")))
    taken = F.col("m_passes") * F.col("m_size") + F.aggregate(
        "m_spans", F.lit(0).cast("long"), lambda acc, s: acc + s["to"] - s["from"])
    more = {"size": F.col("m_size"), "source_size": F.col("s_size"), "target": F.col("s_target"),
            "taken": taken, "take_passes": F.col("m_passes"), "take_spans": F.col("m_spans")}
    return rows.select("m_row.*", *[c.alias(free_name(docs, n)) for n, c in more.items()])


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    sized = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                              n_words(F.col("text")).alias("w_size")), "mix-docs")
    return mix(sized, F.col("w_size")).select("doc_id", "size", "source_size", "target", "taken")


def cut_words(text: str, start: int, end: int) -> str:
    """The text from its word ``start`` to the end of its word ``end - 1``."""
    words = _WORD.finditer(text)
    first = next(islice(words, start, None))
    last = first if end - start == 1 else next(islice(words, end - start - 2, None))
    return text[first.start():last.end()]


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a copy of a document for every whole pass and, of the last
    pass, the text between the first and the last word of each taken span.
    ``n_chars`` follows a cut text; the other columns stay.

    The mix is worked out on ids, sizes and row hashes.  Texts move once, to the
    number of their copies; those that are cut, or whose row comes more than once, go
    by one text a row hash instead, salted by the number of equal rows.
    """
    ship(docs.sparkSession)
    key = ["k_one", "k_two"]
    keyed = docs.select(F.struct(*own_columns(docs)).alias("k_row"), row_hash(docs, SEED).alias("k_one"),
                        row_hash(docs, SEED + 1).alias("k_two"))
    narrow = stage(keyed.select(*key, F.col("k_row.doc_id").alias("doc_id"), F.col("k_row.source").alias("source"),
                                n_words(F.col("k_row.text")).alias("k_size"),
                                F.rand(SEED).alias("k_place")), "mix-narrow")
    one = F.struct(F.lit(0).cast("long").alias("from"), F.col("k_size").alias("to"))
    taken = stage(mix(narrow, F.col("k_size")).select(
        *key, "k_size", "k_place", F.when(F.col("k_size") > 0, F.concat(
            F.array_repeat(one, F.col("take_passes").cast("int")), F.col("take_spans"))).alias("k_parts")),
        "mix-taken")
    some = taken.filter(F.size("k_parts") > 0)
    is_cut = F.exists("k_parts", lambda p: (p["from"] > 0) | (p["to"] < F.col("k_size")))
    special = stage(taken.groupBy(*key)
                    .agg(F.count(F.lit(1)).alias("n"), F.max(F.coalesce(is_cut, F.lit(False))).alias("cut"))
                    .filter("n > 1 OR cut").select(*key, F.ceil(F.col("n") / SALT_ROWS).alias("k_salts")),
                    "mix-special")
    plain = some.join(special, key, "left_anti").select(*key, F.size("k_parts").alias("k_copies"))
    whole = (keyed.join(plain.hint("shuffle_hash"), key)
             .select("k_row", F.explode(F.sequence(F.lit(1), "k_copies"))).select("k_row.*"))
    parts = some.join(special, key).select(
        *key, "k_size", F.floor(F.col("k_place") * F.col("k_salts")).alias("k_salt"),
        F.explode("k_parts").alias("k_part"))
    likely, _ = split_by_bitmap(keyed, F.col("k_one"), hash_bitmap(special, F.col("k_one")))
    texts = (likely.dropDuplicates(key).join(special, key)
             .select(*key, "k_row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k_salts") - 1)).alias("k_salt")))
    extra = [free_name(docs, n) for n in ("k_size", "k_from", "k_to")]
    cut = texts.join(parts, [*key, "k_salt"]).select("k_row.*", *[c.alias(n) for c, n in zip(
        (F.col("k_size"), F.col("k_part.from"), F.col("k_part.to")), extra)])
    return whole.union(map_arrow(cut, _cutter(docs.columns), docs.schema))


def _cutter(columns: list[str]):
    """Cuts the texts of rows that end with (size, from, to), in short batches."""
    text, chars = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                part = whole.slice(at, 64)
                arrays = part.columns[:len(columns)]
                new = [t.as_py() if (a, b) == (0, n) else cut_words(t.as_py(), a, b)
                       for t, n, a, b in zip(arrays[text], *(c.to_pylist() for c in part.columns[len(columns):]))]
                if chars is not None:
                    arrays[chars] = pa.array(
                        [n if t.as_py() == x else len(x)
                         for n, t, x in zip(arrays[chars].to_pylist(), arrays[text], new)], arrays[chars].type)
                arrays[text] = pa.array(new, arrays[text].type)
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return run
