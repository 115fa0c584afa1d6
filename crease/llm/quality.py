"""Quality rules as a short-circuit cascade.

Every rule needs some counts of a text; counts differ a lot in cost.  Each task
measures a bounded sample of its own documents: the seconds of every count, and how
many documents each combination of rules rejects.  The rule with most rejections per
second comes first, then the one with most rejections per second among the documents
left, where counts that are there already cost nothing.  A document meets no further
rule after the first that rejects it.  A rule's verdict depends on the document
alone, so the order -- and with it the sample -- changes the time, never the
result.

Counts (words are ``[^\\x20\\x09-\\x0D]+``; a null text has none of anything):

* ``n_words``, ``word_chars`` (code points in words);
* ``n_symbols``: characters of ``#*$%&|<>``;
* ``n_dup_lines``: lines with a word that equal an earlier line;
* ``n_repeat_words``: words inside a 3-word window that occurs twice or more.

Edge cases: null and empty texts have no words and are rejected by
``few_words``; repeated rows are judged one by one; an empty table gives no
rows; :func:`keep_documents` hands on every input column under its own name.
"""
from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import map_arrow, ship

SAMPLE_ROWS = 64             # documents of each task that costs and rejections are estimated on
SYMBOLS = "#*$%&|<>"


class TextCounts:
    """Counts of one text, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    def __getattr__(self, name: str) -> int:
        if name.startswith("_"):
            raise AttributeError(name)
        value = _COUNTS[name](self)
        setattr(self, name, value)
        return value


def _words(t: TextCounts) -> list[bytes]:
    return t.text.encode("utf-8", "surrogatepass").split()     # splits at 0x20 and 0x09-0x0D only


def _word_chars(t: TextCounts) -> int:
    return len(t.text) - sum(map(t.text.count, " \t\n\x0b\x0c\r"))


def _symbols(t: TextCounts) -> int:
    return sum(map(t.text.count, SYMBOLS))


def _lines(t: TextCounts) -> list[str]:
    return [x for x in t.text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]


def _repeat_words(t: TextCounts) -> int:
    """Windows are compared as exact numbers: word numbers, then numbers of word
    pairs joined with the third word's number."""
    words = t.words
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    w = np.fromiter((numbers.setdefault(x, len(numbers)) for x in words), np.int64, len(words))
    v = len(numbers)
    if v > len(words) - 3:                       # hardly a word comes twice: no window does
        return 0
    pair = np.unique(w[:-1] * v + w[1:], return_inverse=True)[1]
    _, which, times = np.unique(pair[:-1] * v + w[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k:len(words) - 2 + k] |= again
    return int(hit.sum())


_COUNTS: dict[str, Callable[[TextCounts], object]] = {
    "words": _words,
    "n_words": lambda t: len(t.words),
    "word_chars": _word_chars,
    "n_symbols": _symbols,
    "lines": _lines,
    "n_lines": lambda t: len(t.lines),
    "n_dup_lines": lambda t: len(t.lines) - len(set(t.lines)),
    "n_repeat_words": _repeat_words,
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[TextCounts], bool]


BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_words", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
METHOD_RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("repeated_lines", lambda t: 2 * t.n_dup_lines > t.n_lines),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
)
RULES = BASE_RULES + METHOD_RULES


def counts_of(rule: Rule) -> set[str]:
    """The counts that a rule asks for."""
    probe = TextCounts("")
    rule.rejects(probe)
    return set(vars(probe)) - {"text"}


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
                  before: tuple[Rule, ...] = (), known: set[str] = frozenset()) -> tuple[Rule, ...]:
    """The rules by rejections per second on a bounded sample, best first.

    Every task samples ``sample_rows`` documents, spread over its first batch, and sends
    back sums alone: the seconds of a count and the number of documents that the same
    rules reject.  Documents that a rule of ``before`` rejects do not count, nor do the
    costs of ``known`` counts.  Ties go to the cheaper rule, then to the given order.
    """
    ship(docs.sparkSession)
    every = (*before, *rules)

    def profile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spent, masks = dict.fromkeys(_COUNTS, 0.0), Counter()
        for batch in batches:
            n = batch.num_rows
            for i in sorted({k * n // sample_rows for k in range(sample_rows)} if n else ()):
                t = TextCounts(batch.column(0)[i].as_py())
                for name in _COUNTS:                 # words and lines first: the others use them
                    t0 = time.perf_counter()
                    getattr(t, name)
                    spent[name] += time.perf_counter() - t0
                masks[sum(r.rejects(t) << k for k, r in enumerate(every))] += 1
            if n:
                break
        yield pa.RecordBatch.from_pydict({
            "name": [*spent, *[None] * len(masks)], "mask": [*[None] * len(spent), *masks],
            "amount": [*spent.values(), *map(float, masks.values())]},
            pa.schema([("name", pa.string()), ("mask", pa.int64()), ("amount", pa.float64())]))

    sums = (docs.select("text").mapInArrow(profile, "name string, mask long, amount double")
            .groupBy("name", "mask").agg(F.sum("amount")).collect())
    cost = {name: amount for name, _, amount in sums if name}
    alive = {mask >> len(before): 0.0 for name, mask, _ in sums if not name}
    for name, mask, n in sums:
        if not name and not mask & ((1 << len(before)) - 1):
            alive[mask >> len(before)] += n
    done, left, order = set(known), list(range(len(rules))), []
    while left:
        def worth(i: int) -> tuple:
            seconds = sum(cost.get(c, 0.0) for c in counts_of(rules[i]) - done)
            return -sum(n for m, n in alive.items() if m >> i & 1) / max(seconds, 1e-9), seconds, i
        best = min(left, key=worth)
        order.append(rules[best])
        left.remove(best)
        done |= counts_of(rules[best])
        alive = {m: n for m, n in alive.items() if not m >> best & 1}
    return tuple(order)


def kept_by(rules: Iterable[Rule], t: TextCounts) -> bool:
    return not any(r.rejects(t) for r in rules)


def keep_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES,
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, all columns as they came."""
    order = cascade_order(docs, rules, sample_rows)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [kept_by(order, TextCounts(x.as_py())) for x in batch.column(at)]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, names=names)

    return map_arrow(docs, run, docs.schema)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = METHOD_RULES,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every document with its counts, ``base_failed`` and ``kept``.

    The counts are the report's columns and so are computed for every text;
    the method's rules cascade over the documents that pass the base rules.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    order = cascade_order(docs, rules, sample_rows, before=BASE_RULES, known=set(_COUNTS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                t = TextCounts(text.as_py())
                failed = not kept_by(BASE_RULES, t)
                rows.append((*(getattr(t, n) for n in names), failed,
                             not failed and kept_by(order, t)))
            cols = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, pa.int64()) for c in cols[:5]]
                + [pa.array(c, pa.bool_()) for c in cols[5:]],
                ["doc_id", *names, "base_failed", "kept"])

    schema = ("doc_id long, " + ", ".join(f"{n} long" for n in names)
              + ", base_failed boolean, kept boolean")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
