"""Periodic runs and token alignment against plain Python."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as E
from crease.llm.periodic_runs import collapse, find_runs, periodic_runs
from crease.llm.token_alignment import align_documents, build_index, pack_bitmap, pair_counts, unpack_bitmap
from tests.conftest import SF_SMALL
from tests.llm.test_queries import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------------ periodic runs
def runs_by_definition(words):
    """Every lag, every diagonal; stretches of several lags belong to the smallest."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w = np.array([number[x] for x in words], np.int64)
    found = {}
    for q in range(1, len(words) // 4 + 1):
        equal = np.r_[False, w[q:] == w[:-q], False].astype(np.int8)
        change = np.diff(equal)
        for i, j in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1)):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((int(i), int(j - i + q)), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_random_words():
    rng = random.Random(5)
    texts = []
    for _ in range(3000):
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        text = [rng.choice("abcd") for _ in range(rng.randint(0, 6))]
        for _ in range(rng.randint(0, 3)):
            text += unit * rng.randint(1, 8) + unit[:rng.randint(0, 9)]
            text += [rng.choice("abcde") for _ in range(rng.randint(0, 5))]
        texts.append(text)
    texts += [["x"] * 500, list("ab") * 300, [], ["x"] * 5, ["x"] * 6, list("abab" * 2), list("aaaaaab" * 40)]
    assert find_runs(texts) == [runs_by_definition(t) for t in texts]


def test_collapse_keeps_the_first_period():
    words = list("xabababababy")
    (runs,) = find_runs([words])
    assert runs == [(1, 10, 2)]
    assert "".join(collapse(words, runs)) == "xaby"


def test_a_very_long_periodic_text():
    unit = [str(i) for i in range(1000)]
    assert find_runs([["y"] * 300_000, unit * 300])[0] == [(0, 300_000, 1)]
    assert find_runs([unit * 300]) == [[(0, 300_000, 1000)]]


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in E.queries()["op12_periodic_runs"](spark, SF_SMALL).collect()}
    docs = table("documents", "doc_id, text")
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        words = planted(doc_id, WORD.findall(text or ""))
        runs = runs_by_definition(words)
        keep = [True] * len(words)
        for s, n, q in runs:
            keep[s + q:s + n] = [False] * (n - q)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
        some += bool(runs)
        assert got[doc_id].asDict() == {
            "doc_id": doc_id, "n_words": len(words), "n_runs": len(runs),
            "start": best[0], "length": best[1], "period": best[2],
            "exponent_milli": 1000 * best[1] // best[2] if runs else None,
            "runs_sha256": hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(
                " ".join(w for w, k in zip(words, keep) if k).encode()).hexdigest()}
    assert some >= 10


def test_runs_of_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 2), (None, "a a a a a a", 3), (4, "a a a a a a", 4), (4, "a a a a a a", 5),
            (5, " b  b\t b\n b\x0b b  b end", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    got = sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"])
                  for r in periodic_runs(docs).collect()), key=str)
    assert got == sorted([(1, 0, [], ""), (2, 0, [], ""), (None, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"),
                          (4, 6, [(0, 6, 1)], "a"), (5, 7, [(0, 6, 1)], " b end")], key=str)
    assert periodic_runs(docs.limit(0)).count() == 0


# ------------------------------------------------------------------ token alignment
@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), {i: t for t, i in a.get_vocab(False).items()}


def aligned(encoders, text):
    """(ids of A, ids of B, groups, links) of a whole text, encoded at once."""
    a, b, names = encoders
    from crease.llm.packing import _byte_letters
    byte = {c: i for i, c in enumerate(_byte_letters())}
    if not text:
        return [], [], [], []
    xs, ys = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    xb = [bytes(byte[c] for c in names[i]) for i in xs]
    yb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
          else b.id_to_piece(i).replace("▁", " ").encode() for i in ys]
    if not b"".join(xb) == b"".join(yb) == (" " + text).encode():
        return [], [], [], []

    def ends(parts):
        at, out = 0, []
        for p in parts:
            at += len(p)
            out.append(at)
        return out

    xe, ye = ends(xb), ends(yb)
    both = sorted(set(xe) & set(ye))
    groups, i, j = [], 0, 0
    for hi in both:
        i0, j0 = i, j
        while i < len(xe) and xe[i] <= hi:
            i += 1
        while j < len(ye) and ye[j] <= hi:
            j += 1
        groups.append(",".join(map(str, xs[i0:i])) + "|" + ",".join(map(str, ys[j0:j])))
    left, right = dict(zip(xe, xs)), dict(zip(ye, ys))
    return xs, ys, groups, [(left[e], right[e]) for e in both]


def expected(encoders, docs):
    all_ = [(i, aligned(encoders, t)) for i, t in docs]
    count = collections.Counter(p for _, x in all_ for p in x[3])
    most = collections.Counter()
    for (x, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((i, len(xs), len(ys), len(g), len(links), sum(count[p] == most[p[1]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(";".join(g).encode()).hexdigest() if xs else "")
                   for i, (xs, ys, g, links) in all_), key=str), count


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [(1, None), (2, ""), (3, "a▁b"), (4, " lead  and trail \n"), (4, " lead  and trail \n"), (None, "x"),
       (6, "<|endoftext|> </s><s><unk> <0x41>"), (7, "ﬁ é é   　x\x1cy \x85z"), (8, "\n\n\t"),
       (9, "it's 1234,56 你好 \U0001f600\U0001f600 naïve"), (10, "word " * 3000), (11, "\x00 a\x00")]


def test_alignment_query_equals_brute_force(spark, encoders):
    got = E.queries()["op11_pair_bitmaps"](spark, SF_SMALL)
    want, _ = expected(encoders, table("documents", "doc_id, text"))
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=str) == want


def test_alignment_of_odd_rows(spark, encoders):
    rng = random.Random(3)
    alphabet = "ab \n\t.,'1é你▁ ​\U0001f600́<>|\x1c᠎"
    rows = ODD + [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30)))) for k in range(400)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, planes int").repartition(3)
    want, count = expected(encoders, rows)
    got = align_documents(docs, A, B)
    assert sorted((tuple(r) for r in got.select(COLUMNS).collect()), key=str) == want
    pairs = pair_counts(build_index(docs, A, B)).collect()
    assert {(r["a"], r["b"]): r["pair_links"] for r in pairs} == dict(count)
    in_docs = collections.Counter(p for _, t in rows for p in set(aligned(encoders, t)[3]))
    assert {(r["a"], r["b"]): r["pair_docs"] for r in pairs} == dict(in_docs)
    assert align_documents(docs.limit(0), A, B).count() == 0


def test_chunks_do_not_change_the_counts(spark, encoders, monkeypatch):
    import crease.llm.token_alignment as T
    monkeypatch.setattr(T, "CHUNK_DOCS", 3)         # what the driver ships by value
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    got = sorted((tuple(r) for r in align_documents(docs, A, B).select(COLUMNS).collect()), key=str)
    assert got == expected(encoders, ODD)[0]


def test_bitmaps_round_trip():
    for numbers in ([0], [65535], list(range(4096)), [1, 5, 4000], list(range(0, 65536, 3))):
        packed = pack_bitmap(np.array(numbers))
        assert unpack_bitmap(packed).tolist() == numbers
        assert len(packed) <= 2 * len(numbers) + 1
