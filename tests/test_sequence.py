"""Distributed running totals / numbering equal a brute-force sort."""
import random

from pyspark.sql import functions as F

from crease.functions import running_totals, sequential_ids


def test_running_totals_many_blocks(spark):
    rnd = random.Random(7)
    data, off = [], 0
    for _ in range(3000):
        off += rnd.randint(1, 3)
        data.append((rnd.choice(["hot", "hot", "hot", "a", "b", None]), off, rnd.randint(0, 6)))
    df = spark.createDataFrame(data, "k string, off long, r int")
    out = running_totals(df, ["k"], "off", {"n": F.lit(1), "s": F.col("r")},
                         block_width=16, with_totals=True,
                         group_mins={"min_r": F.col("r") * 10 + F.col("off") % 7},
                         next_col="next_off")
    got = {(r.k, r.off): (r.n, r.s, r.n_total, r.s_total, r.min_r, r.next_off)
           for r in out.collect()}
    seen, tot, mins, nxt = {}, {}, {}, {}
    for k, o, r in data:
        c = tot.setdefault(k, [0, 0])
        c[0] += 1
        c[1] += r
        mins[k] = min(mins.get(k, 10**9), r * 10 + o % 7)
    by_key = {}
    for k, o, _ in sorted(data, key=lambda t: t[1]):
        by_key.setdefault(k, []).append(o)
    for offs in by_key.values():
        for a, b in zip(offs, offs[1:] + [None]):
            nxt[a] = b
    for k, o, r in sorted(data, key=lambda t: t[1]):
        c = seen.setdefault(k, [0, 0])
        c[0] += 1
        c[1] += r
        assert got[(k, o)] == (c[0], c[1], tot[k][0], tot[k][1], mins[k], nxt[o])
    assert len(got) == len(data)


def test_sequential_ids_dense_and_ordered(spark):
    names = [f"n{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "name string")
    out = sorted((r.id, r.name) for r in sequential_ids(df, ["name"], num_partitions=7).collect())
    assert out == [(i + 1, n) for i, n in enumerate(names)]


def test_sequential_ids_with_payload_and_without_exchange_reuse(spark):
    """Sampled ranges may differ from plan to plan; ids must not."""
    n = 3_000_000
    df = (spark.range(n).select(F.concat(F.lit("k"), F.hash("id") % 1000, F.lit("-"), "id").alias("name"),
                                F.xxhash64("id").alias("payload")))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        out = sequential_ids(df, ["name"], num_partitions=50)
        got = out.agg(F.countDistinct("id"), F.min("id"), F.max("id"), F.count("payload")).first()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert tuple(got) == (n, 1, n, n)


def test_running_totals_shuffles_the_rows_once(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("off"), F.lit(1).alias("r"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = running_totals(df, ["k"], "off", {"n": F.lit(1)})._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # the window above the join needs no exchange of its own
    assert "Window" in plan and "Exchange" not in plan[:plan.index("SortMergeJoin")]
