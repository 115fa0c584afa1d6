"""The grouped prefix join against all pairs compared."""
import random
import re

import pytest

from crease.llm.shingle_join import shingle_set, similar_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def by_definition(rows):
    """doc_id -> (set size, smallest id that links reach), by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = WORD.findall((text or "").translate(LOWER))
        k = min(3, len(words))
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 90 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(sets[i]), d if not sets[i] else least.get(find(i))) for i, (d, _) in enumerate(rows)),
                  key=str)


def result(spark, rows, **more):
    docs = spark.createDataFrame([(*r, b"x", 0) for r in rows], "doc_id long, text string, key binary, gid int")
    return sorted((tuple(r) for r in similar_components(docs.repartition(3)).collect()), key=str)


def edited(rng, words, edits, kinds):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.choice(kinds)
        if kind == "swap":
            words[at] = f"new{rng.randrange(10 ** 6)}"
        elif kind == "cut":
            del words[at]
        else:
            words.insert(at, f"more{rng.randrange(10 ** 6)}")
    return words


@pytest.mark.parametrize("kinds", [["swap"], ["cut"], ["swap", "cut", "add"]])
def test_circles_of_edited_copies(spark, kinds):
    """Copies near the limit of similarity, the original not among them, beside texts
    that share a passage with many others."""
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for circle in range(4):
        base = [f"w{rng.randrange(2000)}" for _ in range(rng.choice([60, 150, 300]))]
        rows += [" ".join(edited(rng, base, rng.randint(1, max(2, len(base) // 25)), kinds)) for _ in range(40)]
    rows += [" ".join(passage + [f"o{rng.randrange(10 ** 6)}" for _ in range(rng.randint(0, 40))]) for _ in range(60)]
    rows += ["same text here"] * 30
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    want = by_definition(rows)
    assert 10 < len({c for _, _, c in want}) < len(rows)
    assert result(spark, rows) == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one"), (7, "one two three"),
            (8, "One\x0btwo  three"), (8, "one two three"), (None, "ONE TWO three"), (None, "lonely words are here"),
            (12, "É é"), (13, "é é"), (14, "a b " * 4000), (15, "a b " * 3000), (16, "x y z " * 30 + "end")]
    assert result(spark, rows) == by_definition(rows)
    assert result(spark, []) == []


def test_shingles_are_sets():
    assert len(shingle_set(b"a b a b a b")) == 2
    assert len(shingle_set(b"a b")) == 1 and len(shingle_set(None)) == 0
