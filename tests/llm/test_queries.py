"""Queries that SQL cannot express, against plain Python over whole small tables."""
import collections
import hashlib
import html
import math
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM read_parquet('{SF_SMALL}/{name}.parquet')").fetchall()


def run(spark, name):
    return [r.asDict() for r in E.queries()[name](spark, SF_SMALL).collect()]


def test_mix_takes_each_source_near_its_target(spark):
    got = run(spark, "op1_sainte_lague_mixing")
    docs = {i: (s, len(WORD.findall(t or ""))) for i, t, s in table("documents", "doc_id, text, source")}
    assert len(got) == len(docs)
    sizes = collections.Counter()
    for s, n in docs.values():
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(order)
    while free:                                    # fill up by weight, stop at twice the size
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not full:
            target.update({s: weight[s] * level for s in free})
            break
        target.update({s: 2.0 * sizes[s] for s in full})
        left -= sum(target[s] for s in full)
        free -= full
    taken = collections.Counter()
    for r in got:
        s, n = docs[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[s])
        assert math.isclose(r["target"], target[s])
        assert 0 <= r["taken"] <= 2 * n
        taken[s] += r["taken"]
    for s in order:
        assert abs(taken[s] - target[s]) <= 32, s           # a block of words or two
    assert sorted(map(str, got)) == sorted(map(str, run(spark, "op1_sainte_lague_mixing")))


def test_extraction_is_the_article(spark):
    got = {r["page_id"]: r for r in run(spark, "op3_html_extraction")}
    pages = table("pages", "page_id, url, html")
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        article = page[page.index("<article>") + 9:page.index("</article>")]
        blocks = [re.sub(r"<[^>]+>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)
        assert got[page_id] == {"page_id": page_id, "url": url, "text": text, "n_chars": len(text)}


def test_chat_windows_give_every_turn_and_target_once(spark):
    said = "</s>[INST] ok [/INST]"
    turns = collections.defaultdict(list, {-1: [(0, "user", said), (1, "assistant", said)]})
    for conv, turn, role, text in table("conversations", "conv_id, turn, role, text"):
        turns[conv].append((turn, role or "", text or ""))
    got = {r["conv_id"]: r for r in run(spark, "op4_chat_windows")}
    assert got.keys() == turns.keys()
    for conv, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(rows)
        assert r["turns_sha256"] == hashlib.sha256(
            "".join(f"{role}\n{text}\n" for _, role, text in rows).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] >= sum(len(x) + len(y) for _, x, y in rows)


def test_packing_places_every_token_once(spark):
    from tokenizers import Tokenizer

    from crease.llm.packing import best_fit_decreasing, lower_bound
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: tok.encode(t or "", add_special_tokens=False).ids + [2] for i, t in table("documents", "doc_id, text")}
    got = run(spark, "op5_best_fit_packing")
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces.keys() == ids.keys()
    for doc, rows in pieces.items():
        rows.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(rows):
            assert (r["piece"], r["start"]) == (k, at)
            part = ids[doc][at:at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r["length"]
            assert r["length"] == 1024 or k == 0
        assert at == len(ids[doc])
        assert len(rows) == -(-at // 1024)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    counts = collections.Counter(r["length"] for r in got)
    assert lower_bound(counts, 1024) <= len(sequences) <= sum(c for _, c in best_fit_decreasing(counts, 1024))
