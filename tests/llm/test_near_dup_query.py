"""The near-duplicate query against all pairs compared, on whole tables."""
import random

import __spark_entry__ as E
from crease.llm.near_dup import near_classes, shingles, weighted_jaccard, words_of
from tests.conftest import SF_SMALL
from tests.llm.test_queries import table


def classes_of_all_pairs(docs, similarity=0.8):
    """doc_id -> smallest doc_id of its class, every pair compared as multisets."""
    bags = {i: shingles(words_of(t)) for i, t in docs}
    ids = [i for i, b in bags.items() if len(b[0])]
    size = {i: int(bags[i][1].sum()) for i in ids}
    root = {i: i for i in bags}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids.sort(key=size.get)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if size[i] < similarity * size[j]:
                break                                       # sizes alone rule out the rest
            if find(i) != find(j) and weighted_jaccard(bags[i], bags[j]) >= similarity:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in bags}


def test_query_equals_all_pairs(spark):
    docs = table("documents", "doc_id, text")
    got = {r["doc_id"]: r["class_id"] for r in E.queries()["op7_bag_minhash"](spark, SF_SMALL).collect()}
    want = classes_of_all_pairs(docs)
    assert len(set(want.values())) < len(want)
    assert got == want


def test_planted_near_copies_are_found(spark):
    """At 0.9 or more no copy is lost; classes equal those of all pairs."""
    rng = random.Random(2)
    docs = []
    for _ in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([80, 200, 400]))]
        docs.append(base)
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 100))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10 ** 6)}"
            docs.append(copy)
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    got = {r["doc_id"]: r["class_id"] for r in near_classes(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes_of_all_pairs(rows)
