"""Periodic runs of words, found by an online sparse DP over diagonals.

A run is a maximal stretch of consecutive words with smallest period q (words q
apart are equal) that holds at least ``REPEATS`` periods and ``SHORTEST`` words.
Comparing a text with itself, words equal at lag q lie on diagonal q: each word's
earlier occurrences lengthen the matches of the diagonals they lie on, and a
diagonal that ends with a long enough match is a run.

The DP is sparse in two ways, and exact:

* **Scales.**  Lags of [G/2, G) are looked for with windows of G words, G = 2, 4, 8,
  ...: a run of period q < G has at least 3q >= G equal words in a row, so each of
  its diagonal's windows is repeated.  Windows are numbered by pairs of the half
  windows' numbers; a window can only recur where both halves do, so most positions
  are gone after two scales.
* **The latest occurrence is enough.**  A window of at least q words of a run with
  smallest period q occurs nowhere less than q before, so the latest earlier
  occurrence lies on the run's own diagonal; multiples of q are never met.  A scale
  thus has one active diagonal at a time, whatever the text repeats.

Work is n log n for a text of n words.  Texts are whole and each is handled by
itself: no shuffle, and a lost task is simply run again.

Edge cases: a null or empty text has no words and no runs, its collapsed text is
empty; a null doc_id is passed on; repeated rows are separate documents; an empty
table gives no rows; other columns are ignored.
"""
from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm.common import ship

REPEATS = 4                  # periods that a run holds at least
SHORTEST = 6                 # words that a run holds at least
SLICE_WORDS = 1 << 18        # words of the texts that are numbered together

RUNS_SCHEMA = ("doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
               "collapsed string")

Run = tuple[int, int, int]   # start, length, period


def _windows(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose code recurs, ascending, and small numbers for their codes."""
    _, number, times = np.unique(codes, return_inverse=True, return_counts=True)
    again = times[number] > 1
    return at[again], number[again]


def _latest(at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, lag to the latest earlier window of the same number), by position."""
    order = np.argsort(number, kind="stable")
    same = number[order[1:]] == number[order[:-1]]
    here, before = order[1:][same], order[:-1][same]
    back = np.argsort(here)
    return at[here[back]], (at[here] - at[before])[back]


def _scan(at: np.ndarray, lag: np.ndarray, window: int) -> Iterator[Run]:
    """Follow the active diagonal from window to window; emit it when it ends."""
    start = last = period = -1
    for i, q in zip(at.tolist() + [-9], lag.tolist() + [0]):
        if i == last + 1 and q == period:            # one more match on this diagonal
            last = i
            continue
        length = last - start + window + period      # words from the first period to the last match
        if start >= 0 and length >= max(SHORTEST, REPEATS * period):
            yield start - period, length, period
        start, last, period = i, i, q


def find_runs(texts: list[list]) -> list[list[Run]]:
    """The runs of each text (a list of words), by start, then period."""
    number: defaultdict = defaultdict(count().__next__)
    codes = np.fromiter((number[w] for t in texts for w in t), np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    begin = np.cumsum([0] + [len(t) for t in texts])
    found: list[list[Run]] = [[] for _ in texts]
    at, live = _windows(owner * (len(number) + 1) + codes, np.arange(len(codes)))
    numbers = np.full(len(codes), -1)
    longest = max((len(t) for t in texts), default=0)
    window = 2
    while len(at) and window // 2 * REPEATS <= longest:
        half = window // 2
        numbers[at] = live
        ahead = at + half
        fits = ahead < len(codes)
        at, ahead = at[fits], ahead[fits]
        both = (numbers[ahead] >= 0) & (owner[ahead] == owner[at])
        left, right = numbers[at[both]], numbers[ahead[both]]
        numbers[:] = -1
        at, live = _windows(left * (len(codes) + 1) + right, at[both])
        where, lag = _latest(at, live)
        near = (lag >= half) & (lag < window)
        for start, length, period in _scan(where[near], lag[near], window):
            doc = owner[start]
            found[doc].append((int(start - begin[doc]), length, period))
        window *= 2
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list, runs: list[Run]) -> list:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def _slices(texts: Iterable[list]) -> Iterator[list[list]]:
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= SLICE_WORDS:
            yield part
            part, size = [], 0
    if part:
        yield part


def periodic_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (by start, then period; words count from 0) and the text
    with every run cut to its first period, words joined by one space."""
    ship(docs.sparkSession)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            at = 0
            # bytes.split takes words as [^\x20\x09-\x0D]+ does
            words = ((t.as_py() or b"").split() for t in batch.column(1))
            for texts in _slices(words):
                runs = find_runs(texts)
                flat = [r for rs in runs for r in rs]
                fields = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
                ends = np.cumsum([0] + [len(rs) for rs in runs]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)),
                     pa.array([len(t) for t in texts], pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
                         fields, ["start", "length", "period"])),
                     pa.array([b" ".join(collapse(t, rs)) for t, rs in zip(texts, runs)]).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])
                at += len(texts)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, RUNS_SCHEMA)
