"""The pipeline's stages, each on what the stage before it kept, against plain Python."""
import collections

import public_tokenizers
import pytest

import corpus_pipeline
from crease.llm import near_dup
from tests.conftest import SF_SMALL
from tests.llm.test_queries import WORD

BLANK = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Input and output rows of every stage, in order."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out.append(([r.asDict() for r in docs.collect()], [r.asDict() for r in after.collect()]))
        docs = after
    return dict(zip((n for n, _ in corpus_pipeline.STAGES), out))


def test_quality(steps):
    before, after = steps["quality_rules"]

    def keep(text):
        words = WORD.findall(text or "")
        grams = collections.Counter(zip(words, words[1:], words[2:]))
        hit = {i + k for i in range(len(words) - 2) for k in range(3) if grams[tuple(words[i:i + 3])] > 1}
        lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
        return (len(words) >= 50 and 100 * len(hit) <= 50 * len(words)
                and 10 * sum(c in "#*$%&|<>" for c in text) <= len(words)
                and 2 * (len(lines) - len(set(lines))) <= len(lines)
                and 2 * len(words) <= sum(map(len, words)) <= 15 * len(words))

    assert {r["doc_id"]: r for r in after} == {r["doc_id"]: r for r in before if keep(r["text"])}


def test_lines(steps):
    before, after = steps["line_dedup"]

    def key(line):
        return line.strip(BLANK).encode().lower()

    seen = collections.Counter(k for r in before for k in {key(x) for x in (r["text"] or "").split("\n")})
    got = {r["doc_id"]: r for r in after}
    assert len(got) == len(before)
    for r in before:
        text = "\n".join(x for x in (r["text"] or "").split("\n") if not key(x) or seen[key(x)] < 10)
        assert got[r["doc_id"]] == {**r, "text": text, "n_chars": len(text)}


def test_near_duplicates(steps):
    before, after = steps["near_dedup"]
    sets = {r["doc_id"]: near_dup.shingles(near_dup.words_of(r["text"])) for r in before}
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(i for i in sets if len(sets[i][0]))
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if near_dup.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    rows = {r["doc_id"]: r for r in before}
    assert {r["doc_id"]: r for r in after} == {i: rows[i] for i in sets if root(i) == i}


def test_mix(steps):
    before, after = steps["mix_sources"]
    sizes = collections.Counter()
    for r in before:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    texts = {r["doc_id"]: r for r in before}
    taken, per_doc = collections.Counter(), collections.Counter()
    for r in after:
        own = texts[r["doc_id"]]
        assert r["text"] in own["text"] and r["n_chars"] == len(r["text"])
        assert (r["source"], r["lang"]) == (own["source"], own["lang"])
        n = len(WORD.findall(r["text"]))
        taken[r["source"]] += n
        per_doc[r["doc_id"]] += n
    assert all(n <= 2 * len(WORD.findall(texts[i]["text"])) for i, n in per_doc.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 0.03 * sum(sizes.values())
    assert all(n <= 2 * sizes[s] for s, n in taken.items())


def test_packing(steps):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    before, after = steps["best_fit_packing"]
    want = collections.Counter((r["doc_id"], len(tok.encode(r["text"], add_special_tokens=False).ids) + 1)
                               for r in before)
    assert sum(n * c for (_, n), c in want.items()) == sum(r["length"] for r in after)
    sequences = collections.defaultdict(list)
    for r in after:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
