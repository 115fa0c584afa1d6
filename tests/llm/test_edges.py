"""Every operator and stage on awkward input: nulls in any column, empty and very
long texts, ties, repeated rows, an empty table, further columns whose names clash."""
import hashlib
import re
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from crease.llm import bm25, chat, html_extract, line_dedup, mixing, near_dup, packing, quality, url_filter, warc

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORDS = [f"word{i}" for i in range(400)]
LONG = " ".join(WORDS[i * i % 400] for i in range(60_000))
GOOD = " ".join(WORDS[:120])
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("size", T.LongType()), T.StructField("n_lines", T.LongType()),
    T.StructField("line_k1", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("m_row", T.StringType()), T.StructField("d_id", T.LongType())])
TEXTS = [(1, GOOD), (2, GOOD), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, LONG), (None, GOOD + " tail"),
         (8, "same line\nother\nsame line"), (9, "x\n\ny"), (1, GOOD), (10, "\u00c9t\u00e9 <|endoftext|> \U0001f600")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 3}", None if t is None else len(t),
             k, k, "k", "n", "m", k) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_every_stage_keeps_columns_and_survives(spark, docs, nothing, tmp_path):
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        for df in (docs, nothing):
            out = stage(spark, df, "")
            rows = out.collect()
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
                assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            if df is nothing:
                assert rows == [], name
    path = str(tmp_path / "documents.parquet")
    docs.write.parquet(path)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_quality_counts(docs, nothing):
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert got[3][1:6] == got[4][1:6] == (0, 0, 0, 0, 0) and got[3].base_failed and not got[3].kept
    assert got[8].n_dup_lines == 1 and got[7].n_words == 60_000
    assert got[1].kept and not got[1].base_failed and not got[7].kept     # LONG repeats its windows
    assert [r.doc_id for r in quality.keep_documents(docs).orderBy("doc_id").collect()] == [None, 1, 1, 2]
    assert quality.judge(nothing).count() == 0


def test_cascade_order_never_changes_the_verdict(docs):
    import itertools
    base = {tuple(r) for r in quality.keep_documents(docs).collect()}
    for order in itertools.islice(itertools.permutations(quality.RULES), 0, 120, 37):
        assert {tuple(r) for r in quality.keep_documents(docs, order).collect()} == base
    order = quality.cascade_order(docs)
    assert sorted(r.name for r in order) == sorted(r.name for r in quality.RULES)


def test_repeat_words_brute_force():
    import random
    for seed in range(200):
        random.seed(seed)
        words = [random.choice("abcde") for _ in range(random.randint(0, 30))]
        grams = Counter(zip(words, words[1:], words[2:]))
        hit = {i + k for i in range(len(words) - 2) for k in range(3) if grams[tuple(words[i:i + 3])] > 1}
        assert quality.TextCounts(" ".join(words)).n_repeat_words == len(hit)


def test_line_dedup_runs_and_rows(spark, docs, nothing):
    shared = [(i, f"only {i}\n  SHARED Line\t\n\nÉ", None, "s", 0, 0, 0, "", "", "", 0) for i in range(20, 32)]
    df = docs.unionByName(spark.createDataFrame(shared, DOCS))
    out = line_dedup.drop_frequent_lines(df, batches=5, fanout=2)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    # the shared line and the one-letter line go; empty lines have no key and stay
    assert [got[i][0].text for i in range(20, 32)] == [f"only {i}\n" for i in range(20, 32)]
    assert (got[20][0].n_lines_, got[20][0].n_dropped) == (4, 2)
    assert got[4][0].text == got[3][0].text == "" and len(got[1]) == 2
    assert got[9][0].text == "x\n\ny" and got[9][0].n_lines_ == 3
    assert out.columns == [*docs.columns, "n_lines_", "n_dropped"]
    # every split into batches and every fanout finds the same frequent lines
    for batches, fanout in ((1, 2), (3, 3), (8, 2)):
        assert line_dedup.frequent_hashes(df, batches=batches, fanout=fanout).count() == 2
    assert line_dedup.drop_frequent_lines(nothing).count() == 0


def test_mixing_edges(spark, docs, nothing):
    got = mixing.mix_report(docs).collect()
    assert len(got) == len(TEXTS)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert sum(r.taken for r in got if r.doc_id in (3, 4, 5)) == 0
    assert mixing.mix_report(nothing).count() == 0
    assert mixing.mix_report(docs.filter("text IS NULL")).collect()[0].taken == 0
    copies = mixing.mixed_documents(docs)
    words = sum(len(r.text.split()) for r in copies.collect())
    assert words == sum(r.taken for r in mixing.mix(docs, mixing.n_words(F.col("text"))).collect())
    assert all(r.n_chars == len(r.text) for r in copies.collect())


def test_captures_without_a_time(spark):
    df = spark.createDataFrame([(i, f"http://h/{i % 2}", "x" * 1200, None if i < 2 else f"2024-01-0{i}T00:00:00Z")
                                for i in range(4)], "page_id long, url string, html string, at string")
    got = warc.archive_and_index(df, F.col("at")).collect()
    assert [(r.urlkey, r.page_id, r.captured is None) for r in got] == [
        ("h)/0", 0, True), ("h)/0", 2, False), ("h)/1", 1, True), ("h)/1", 3, False)]


def test_mixing_tiny_sources(spark):
    for n in (1, 3, 25):
        df = spark.createDataFrame(
            [(i, "a " * n, "small") for i in range(1)] + [(10 + i, "b c " * 500, "zlarge") for i in range(50)],
            "doc_id long, text string, source string")
        got = [r for r in mixing.mix_report(df).collect() if r.doc_id == 0]
        assert abs(got[0].taken - got[0].target) <= 1, got


def test_mixing_copies_of_one_row(spark):
    """Equal rows share one text; every row's copies come out."""
    same, names = "w " * 30 + "end", ["doc_id", "text", "source", "n_chars", "a.b"]
    rows = [(1, same, "s", 63, "x")] * 3000 + [(k, f"t{k} " * 20, "u" if k % 2 else None, 1, None) for k in range(2, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, extra string").toDF(*names)
    out = mixing.mixed_documents(df).collect()
    want = mixing.mix(df, mixing.n_words(F.col("text"))).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()
    got = Counter()
    for r in out:
        got[r.doc_id] += len(r.text.split())
    assert {r.doc_id: r.t for r in want if r.t} == dict(got)
    assert all(r["a.b"] == ("x" if r.doc_id == 1 else None) for r in out)


def test_stages_keep_columns_with_dots(spark, docs):
    dotted = docs.withColumnRenamed("m_row", "a.b")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, dotted, "")
        assert out.columns == dotted.columns and {r["a.b"] for r in out.collect()} <= {"m"}, name


def test_sainte_lague_against_single_seats():
    import random
    for seed in range(60):
        random.seed(seed)
        votes = [random.choice([0, 1, 3, 7.5, 100]) * random.random() for _ in range(random.randint(1, 7))]
        most = [random.randint(0, 40) for _ in votes]
        seats = random.randint(0, 60)
        want = [0] * len(votes)
        for _ in range(min(seats, sum(m for m, v in zip(most, votes) if v > 0))):
            free = [i for i in range(len(votes)) if want[i] < most[i] and votes[i] > 0]
            i = max(free, key=lambda i: (votes[i] / (2 * want[i] + 1), -i))
            want[i] += 1
        assert mixing.sainte_lague(votes, seats, most) == want


def test_cut_words_keeps_the_text_between():
    text = "  a  b\n\nc\td "
    assert mixing.cut_words(text, 0, 2) == "a  b"
    assert mixing.cut_words(text, 1, 4) == "b\n\nc\td"
    assert mixing.cut_words(text, 2, 3) == "c"


def test_near_duplicates_edges(spark, docs, nothing):
    got = {}
    for r in near_dup.near_classes(docs).collect():
        got.setdefault(r.doc_id, r.class_id)
    assert got[1] == got[2] == got[None] == 1              # copies, and one word more
    assert [got[i] for i in (3, 4, 5, 6, 7)] == [3, 4, 5, 6, 7]
    kept = near_dup.one_per_class(docs).collect()
    assert Counter(r.doc_id for r in kept) == Counter({i: 1 for i in range(1, 11) if i != 2})
    assert near_dup.near_classes(nothing).count() == 0


def test_one_per_class_with_repeated_and_null_ids(spark):
    a, b = " ".join(WORDS[:100]), " ".join(WORDS[200:300])
    rows = [(7, a), (7, b), (7, ""), (8, a), (None, ""), (None, ""), (None, None), (9, " "), (9, " "),
            (None, "all ids null"), (None, "all ids null")]
    kept = near_dup.one_per_class(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter(
        [(7, a), (7, b), (7, ""), (None, ""), (None, ""), (None, None), (9, " "), (9, " "), (None, "all ids null")])


def test_bag_minhash_is_unbiased_on_weights():
    import numpy as np
    a = near_dup.shingles("a a a a a b b c d d d d d d d d d".split(), 1)
    b = near_dup.shingles("a a b b b b c c e d d d d d".split(), 1)
    keys, weights = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
    s = near_dup.bag_minhash(keys, weights, np.repeat([0, 1], [len(a[0]), len(b[0])]), 2, 20_000)
    assert abs((s[0] == s[1]).mean() - near_dup.weighted_jaccard(a, b)) < 0.02


@pytest.mark.parametrize("low", [3, 7, 15])
def test_bag_minhash_between_powers_of_two(low):
    # a passage of 40 words, `low` times against one time more
    import numpy as np
    passage = [f"p{i}" for i in range(40)]
    a, b = near_dup.shingles(passage * low), near_dup.shingles(passage * (low + 1))
    true = near_dup.weighted_jaccard(a, b)
    keys, weights = map(np.concatenate, zip(a, b))
    owner = np.repeat([0, 1], [len(a[0]), len(b[0])])
    s = near_dup.bag_minhash(keys, weights, owner, 2, 20_000)
    assert abs((s[0] == s[1]).mean() - true) < 0.02
    # 200 pairs through the bands
    met = 0
    for salt in range(200):
        salted = near_dup._mix(keys + np.uint64(salt + 1))
        x, y = near_dup.band_hashes(near_dup.bag_minhash(salted, weights, owner, 2))
        met += bool((x == y).any())
    assert met >= 200 * (1 - (1 - true ** near_dup.ROWS) ** near_dup.BANDS) - 6


def test_prefix_rows_grow_with_the_prefix_only(spark):
    """A look-alike of 100,000 words in an open circle: rows of a bounded size, one a prefix token."""
    n = 100_000
    long, hub = [[f"{c}{i}" for i in range(n)] for c in "ab"]
    texts = spark.createDataFrame([(bytearray(b"h" * 16), " ".join(hub)), (bytearray(b"x" * 16), " ".join(long))],
                                  "node binary, text string")
    pairs = spark.createDataFrame([(bytearray(b"h" * 16), bytearray(b"x" * 16))], "hub binary, node binary")
    tokens = near_dup.rare_first_prefixes(pairs, texts)
    size = n - near_dup.SHINGLE + 1
    got = tokens.agg(F.count("*"), F.max("pos"), F.min("size"), F.max(F.size("before"))).first()[:]
    assert got == (size // 5 + 1, size // 5, size, near_dup.EARLIER)
    rows = {r.pos: r for r in tokens.filter("pos < 30").collect()}
    assert rows[0].before == [] and rows[3].before == [rows[i].bucket for i in range(3)]
    assert rows[29].before == [rows[i].bucket for i in range(29 - near_dup.EARLIER, 29)]


def test_prefix_pairs_come_once(spark):
    """Many common first tokens give one row; a first common token too late gives none."""
    rows = [(b, node, pos, 100, []) for node, ps in (("x", range(12)), ("y", range(12)), ("z", range(15, 21)))
            for b, pos in enumerate(ps)]
    tokens = spark.createDataFrame(rows, "bucket long, node string, pos long, size long, before array<long>").withColumn(
        "node", F.col("node").cast("binary"))
    none = spark.createDataFrame([], "node binary, label binary")
    got = [(bytes(r.hub), bytes(r.node)) for r in near_dup.prefix_pairs(tokens, none).collect()]
    assert got == [(b"x", b"y")]


def test_near_duplicate_circles(spark):
    """Pairs that no hub links: variants alike among themselves, not like the hub."""
    base = WORDS[:100]
    docs = [(0, base)]
    docs += [(i, base[:60] + [f"v{i}x{k}" for k in range(60)]) for i in range(1, 30)]
    docs += [(100 + i, base[:60] + [f"v{i}x{k}" for k in range(57)] + ["z", "z", "z"]) for i in range(1, 30, 4)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dup.near_classes(df).collect()}
    sets = {i: near_dup.shingles([x.lower() for x in w]) for i, w in docs}
    for i in sets:
        for j in sets:
            if i < j and near_dup.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                assert got[i] == got[j], (i, j)
    assert len(set(got.values())) == len({i if i < 100 else i - 100 for i in sets})


def test_packing_edges(spark, docs, nothing):
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    assert Counter(r.doc_id for r in rows if r.piece == 0)[1] == 2
    assert [r.length for r in rows if r.doc_id in (3, 4)] == [1, 1]
    assert {r.length for r in rows if r.doc_id == 7 and r.piece} == {1024}
    assert packing.pack_documents(nothing, TOKENIZER).count() == 0


def test_word_cache_gives_the_tokenizers_ids():
    import random

    import numpy as np
    from tokenizers import Tokenizer
    tok, own = Tokenizer.from_file(TOKENIZER), packing.WordTokenizer(TOKENIZER)
    random.seed(4)
    alphabet = list(" \n\t'.,!?%\u00b2\u21673ab c\u00c9\u00e9\u00df \u0301\x1c\x85\xa0_|'s're<|endoftext|>\u6f22\U0001f600")
    for _ in range(4000):
        text = "".join(random.choices(alphabet, k=random.randint(0, 14)))
        want = np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own.packed_ids(text) == want, text


def test_search_edges_and_brute_force(spark, docs, nothing):
    got = bm25.top_k(docs, F.col("doc_id").isin(1, 3, 4, 6), k=3, shard_docs=4, query_block=2).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.doc_id))
    assert 3 not in by and 4 not in by                      # no words, no results
    assert [i for _, i in sorted(by[1])] == [1, 1, 2]       # ties: the smaller id first
    assert [i for _, i in sorted(by[6])] == [6]
    assert bm25.top_k(nothing, F.col("doc_id") == 1).count() == 0


def test_search_is_the_same_for_any_shards(spark):
    import random
    random.seed(8)
    vocab = [f"t{i}" for i in range(300)]
    rows = [(i, " ".join(random.choices(vocab[:20] if i % 3 else vocab, k=random.randint(1, 60)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = None
    for shard, block in ((16, 500), (100, 7), (400, 40)):
        got = sorted(map(tuple, bm25.top_k(df, F.col("doc_id") % 20 == 0, 5, shard, block).collect()))
        assert want is None or got == want
        want = got
    assert len(want) == 20 * 5


def test_url_edges(spark):
    urls = ["http://EN.example.NET/en/x", "https://a.example.com/de/y", "http://net", "http://net/", None, "", "no-scheme",
            "x://fr.org/fr/?q", "x://org/fr", "http://spam-farm.example.org/", "http://good.example.org/spam/farmer",
            "http://u@host.net:80/", "http://a.org/CASINO", "http://sub.net/path#http://x.org/fr/", "http://a\nb.net/"]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: tuple(r)[1:] for r in url_filter.judge_urls(df).collect()}
    assert got[0] == ("en.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("a.example.com", "/de/y", "example.com/de/", "block")
    assert got[2] == ("net", "", None, "allow") and got[3] == ("net", "/", "net/", "block")
    assert got[4] == got[5] == got[6] == ("", "", None, "allow")
    assert got[7][2:] == ("org/fr/", "allow") and got[8][2:] == (None, "allow")
    assert got[9][2:] == (None, "block") and got[10][2:] == (None, "allow")
    assert got[11][2:] == (None, "allow") and got[12][2:] == (None, "block")
    assert got[13][2:] == ("net/", "block") and got[14][2:] == ("net/", "block")
    # the index finds what all rules on every url find
    index = url_filter.RuleIndex(url_filter.RULES, {})
    for u in filter(None, urls):
        host, path = url_filter.url_parts(u)
        hits = [r for r in url_filter.SITE_RULES if "://" in u and re.search(r.pattern, host + path)]
        best = max(hits, key=lambda r: len(r.site), default=None)
        assert index.judge(u)[2] == (best and best.site)


def test_chat_edges(spark):
    marks = "</s> <\\s> [INST] [/\\INST] \\ <s><s> [\\\\INST]"
    turns = [(1, 0, "system", "be kind", "a"), (1, 1, "user", None, "b"), (1, 2, "assistant", marks, "c"),
             (1, 3, "assistant", "w " * 900, "d"), (1, 4, "user", "short", "e"), (1, 5, "assistant", "ok", "f"),
             (2, None, None, None, "g"), (2, 1, "assistant", "", "h"), (None, 1, "user", "x", "i"), (None, 1, "user", "x", "j")]
    turns += [(3, k, ("user", "assistant")[k % 2], "some words " * (k % 7), "k") for k in range(300)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, window string")
    windows = chat.format_conversations(df, budget=120, history=40)
    got = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    for conv in (1, 2, 3, None):
        rows = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, _ in turns if c == conv))
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in rows)
        loss = "".join(x for _, _, r, x in rows if r == "assistant")
        assert got[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(rows), len(loss))
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    read = chat.read_turns(windows).collect()
    for r in read:                                          # budgets, and the system turn first
        tokens = [len(t.text.split()) + len(t.role.split()) + chat.MARK_TOKENS for t in r.turns]
        assert sum(tokens) <= 120 or len(r.turns) - r.first_new == 1
        assert r.conv_id != 1 or r.turns[0].role == "system"
    assert any(r.first_new for r in read)
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x\r\n\r\nWARC/1.1\r\n" * 100 + "é</p>"
    rows = [(1, "http://www.b.com/1", big, "z"), (2, "http://a.com/2#f", big, "z"), (3, None, None, "z"), (None, "http://a.com/2", big, "z"),
            (4, "http://a.com/2\r\nX: y", "small", "z"), (5, "u", "small", "z"), (2, "http://a.com/2", big, "z"), (6, "", "", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string").repartition(3)
    got = warc.archive_and_index(df, F.lit("2024-01-01T00:00:00Z"), str(tmp_path / "warc")).collect()
    assert len(got) == len(rows)
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in got) == Counter({
        (1, "revisit", 2): 1, (2, "response", None): 2, (None, "revisit", 2): 1, (3, "response", None): 1,
        (4, "response", None): 1, (5, "response", None): 1, (6, "response", None): 1})
    for r in got:
        html = {1: big, 2: big, None: big, 3: "", 4: "small", 5: "small", 6: ""}[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(html.encode()), hashlib.sha1(html.encode()).hexdigest())
    keys = [warc.capture_order(tuple(r)) for r in got]
    assert keys == sorted(keys)                             # one global order
    empty = warc.archive_and_index(df.limit(0), F.lit("2024-01-01T00:00:00Z"), str(tmp_path / "none"))
    assert empty.count() == 0


def test_loser_tree_merges_sorted_runs():
    import random
    for seed in range(50):
        random.seed(seed)
        runs = [sorted(random.choices(range(50), k=random.randint(0, 20))) for _ in range(random.randint(0, 9))]
        got = list(warc.loser_tree_merge([iter(r) for r in runs], lambda x: x))
        assert got == sorted(x for r in runs for x in r)


def test_html_edges(spark):
    page = ("<body><div class='site-header'>top</div><div id=menu>m</div><main><h1>T&eacute;st</h1><p>One, two.<p>Th<b>re</b>e"
            "<br>x<ul><li>a<li>b</ul><div class='comments'><p>me too!</p></div><form><p>name</p></form><script>if(a<b){'</p>'}</script>"
            "</main><aside>s</aside><footer>f</footer>")
    cases = {1: (page, "T\u00e9st\n\nOne, two.\n\nThree x\n\na\n\nb"), 2: (None, ""), 3: ("", ""), 4: ("<p></p>", ""),
             5: ("just text &lt;b&gt;", "just text <b>"), 6: ("<article>" + "<div>deep" * 3000, "\n\n".join(["deep"] * 3000)),
             7: ("<script>never closed", ""), 8: ("a <b <c", "a <b <c")}
    df = spark.createDataFrame([(i, None, h, "t") for i, (h, _) in cases.items()], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract(df).collect()}
    for i, (_, text) in cases.items():
        assert (got[i].text, got[i].n_chars) == (text, len(text)), i


SENTENCES = "<p>One long sentence, with commas, and more words that follow it. Then another one, of a like length, ends here.</p>"


def test_html_scores_choose_without_article_elements():
    """The supplied pages with the article's tags renamed: the same text, headings too."""
    import pyarrow.parquet as pq
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column(0).to_pylist()
    for page in pages:
        want = html_extract.main_text(page)
        renamed = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert html_extract.main_text(renamed) == want


def test_html_containers_by_their_score():
    s = SENTENCES
    cases = {  # page: sentences found, what else must be there
        f"<article>promo</article><div>{s * 3}</div>": (3, ""),
        f"<div><section>{s * 13}</section><div>{s * 7}</div></div><div>x</div>": (20, ""),
        f"<div><h1>Title</h1><div>{s * 4}</div></div><p>legal</p>": (4, "Title"),
        f"<div>{s}<ul>{'<li>go' * 12}</ul>{s}</div>": (2, "go"),
    }
    for page, (n, other) in cases.items():
        got = html_extract.main_text(page)
        assert (got.count("One long"), other in got, "promo" in got) == (n, True, False), page


def test_html_nothing_is_lost_by_a_name():
    s = SENTENCES
    cases = {  # page: sentences found, what else must be there
        f"<div class='layout has-sidebar'><article>{s}</article><div class=sidebar>x</div></div>": (1, ""),
        f"<article><div class='article-header'><h1>Title</h1></div><div class='social-science'>{s * 2}</div>{s}</article>": (3, "Title"),
        f"<div class=sidebar>{s * 3}</div><p>x</p>": (3, ""),
        f"<form id=page><div>{s * 3}</div></form>": (3, ""),
        "<aside><article>promo</article></aside><div>story</div>": (0, "story"),
    }
    for page, (n, other) in cases.items():
        got = html_extract.main_text(page)
        assert (got.count("One long"), other in got, "promo" in got) == (n, True, False), page


def test_html_content_beside_the_paragraphs_stays():
    para = "A long paragraph, with several clauses, and with marks; it says something of the story. It goes on. "
    six = "".join(f"<p>{para}{i}</p>" for i in range(6))
    steps = "".join(f"<li>step {i}</li>" for i in range(8))
    links = "".join(f"<li><a href='/{i}'>link {i}</a></li>" for i in range(3))
    title = "<h1>Title</h1>"
    cases = [
        (f"{title}{six}<h2>Steps</h2><ul>{steps}</ul>", ["Steps", "step 0", "step 7"], []),
        (f"<header><h1>Inside</h1><p>by somebody</p><nav><h2>Menu</h2></nav></header>{six}", ["Inside"], ["somebody", "Menu"]),
        (f"{title}{six}<pre>x = 1 <span class='comment'># why</span></pre>{six}", ["# why"], []),
        (f"{title}{six}<table class='form'><tr><td>cell</td></tr></table>{six}", ["cell"], []),
        (f"{title}{six}<p class='menu'>{para} named</p>{six}", ["named"], []),
        (f"{title}{six}<p class='advert'>Buy it</p>{six}", [], ["Buy it"]),
        (f"{title}<p>{para}one</p><p title='it's ok'>{para}two</p><p>{para}three</p>", ["one", "two", "three"], []),
        (f"{title}{six}<h2>Elsewhere</h2><ul>{links}</ul>", ["It goes on. 5"], ["Elsewhere", "link 0"]),
    ]
    for body, kept, gone in cases:
        got = html_extract.main_text(f"<body><nav><a href='/'>Home</a></nav><article>{body}</article><footer>Foot</footer></body>")
        for text in kept:
            assert text in got, (body, text)
        for text in [*gone, "Home", "Foot"]:
            assert text not in got, (body, text)


def test_html_time_is_linear_in_open_quotes():
    import time

    def seconds(page):
        start = time.process_time()
        html_extract.main_text(page)
        return time.process_time() - start

    for piece in ('<a "', '<a title="', "<a ='", "<p ", "<!--"):
        assert seconds(piece * 40000) < 20 * max(0.05, seconds(piece * 4000)), piece


def test_frequent_words_outlive_a_full_cache(monkeypatch):
    """A word that comes again and again is tokenized once, however many others come between."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 8)
    tok = packing.WordTokenizer(TOKENIZER)
    asked, ids = [], tok._rest.compute
    tok._rest.compute = lambda part: asked.append(part) or ids(part)
    texts = [f"first often word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    plain = packing.WordTokenizer(TOKENIZER)
    assert [tok.packed_ids(t) for t in texts] == [plain._encode(t) for t in texts]
    assert asked.count("often") == 1 and len(asked) == 61
    assert len(tok._rest) + len(tok._rest.older) < 30


def test_search_remembers_few_words(monkeypatch):
    """The cache of word hashes stays small and keeps the words it met first."""
    monkeypatch.setattr(bm25, "CACHE_WORDS", 4)
    monkeypatch.setattr(bm25, "_WORDS", {})
    texts = [f"a b Word{i} word{i}" for i in range(20)]
    got = [dict(zip(*map(lambda x: x.tolist(), bm25.word_counts(t)))) for t in texts]
    assert [sorted(g.values()) for g in got] == [[1, 1, 2]] * 20
    assert len({h for g in got for h in g}) == 22
    assert len(bm25._WORDS) == 4 and {b"a", b"b"} <= set(bm25._WORDS)


def test_search_builds_and_reads_shards_in_little_memory():
    # an executor's workers each hold one shard at a time: few bytes a posting, stored and in the making
    import tracemalloc

    import numpy as np
    rng = np.random.default_rng(8)
    texts = [" ".join(map(str, rng.zipf(1.3, 300) % 50_000)) for _ in range(3000)]
    words = [bm25.word_counts(t) for t in texts]
    postings = sum(len(w) for w, _ in words)
    tracemalloc.start()
    shard = bm25.build_shard(list(range(3000)), words)
    built = tracemalloc.get_traced_memory()[1]
    raw = {p: a.tobytes() for p, a in shard.items()}
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    ready = bm25.Shard(raw, float(shard["lengths"].mean()))
    read = tracemalloc.get_traced_memory()[1] - before - ready.dense.nbytes
    tracemalloc.stop()
    assert len(raw["docs"]) == 2 * postings and len(raw["tfs"]) <= 2 * postings
    assert built < 45 * postings and read < 30 * postings, (built / postings, read / postings)
    # the narrow form loses nothing
    df = np.diff(ready.starts)
    back = [{} for _ in texts]
    for t, d, tf in zip(np.repeat(shard["terms"], df).tolist(), ready.docs.tolist(), shard["tfs"].tolist()):
        back[ready.ids[d]][t] = tf
    assert back == [dict(zip(*map(lambda x: x.tolist(), bm25.word_counts(t)))) for t in texts]


def test_search_scores_blocks_of_the_querys_kind_alone():
    # four vocabularies: a query with a threshold multiplies no row of another one's documents
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(5)
    texts = [" ".join(f"{'abcd'[i % 4]}{x}" for x in rng.zipf(1.3, int(rng.integers(20, 400))) % 3000) for i in range(1600)]
    words = [bm25.word_counts(t) for t in texts]
    lengths = np.array([c.sum() for _, c in words])
    docs = [dict(zip(w.view("<i8").tolist(), c.tolist())) for w, c in words]
    shard = bm25.build_shard(list(range(1600)), words)
    ready = bm25.Shard({p: a.tobytes() for p, a in shard.items()}, float(lengths.mean()))
    df = {t: int(x) for t, x in zip(shard["terms"].view("<i8").tolist(), shard["dfs"])}
    norm = bm25.K1 * (1 - bm25.B + bm25.B * lengths / lengths.mean())
    places = {t: int(i) for t, i in zip(ready.names.tolist(), ready.by_name)}

    def brute(weights):
        return [round(sum(w * d[t] * (bm25.K1 + 1) / (d[t] + norm[i]) for t, w in weights.items() if t in d), 6)
                for i, d in enumerate(docs)]

    asked = [i for i in range(0, 160, 5) if i % 4 == 0]
    weights = [{t: c * float(np.log(1 + (1600 - df[t] + .5) / (df[t] + .5))) for t, c in docs[i].items()} for i in asked]
    scores = [brute(w) for w in weights]
    at = [np.array([places[t] for t in w]) for w in weights]
    values = [np.array(list(w.values())) for w in weights]
    for known in (np.zeros(len(asked)), np.array([sorted(s)[-10] for s in scores])):
        got = {i: dict(zip(ready.ids[d].tolist(), s.tolist())) for i, d, s in ready.search(at, values, 10, known)}
        for i, s in enumerate(scores):
            want = {d: x for d, x in enumerate(s) if x >= sorted(s)[-10]}
            assert got[i].keys() == want.keys()
            assert all(abs(got[i][d] - want[d]) < 2e-6 for d in want)
        others = [k for k in ready.kinds if all(ready.ids[d] % 4 for d in range(k[3][0], k[4][-1]))]
        assert sum(k[4][-1] - k[3][0] for k in others) > 800      # what the second round must not touch
        for k in others:
            k[1][:] = np.nan
    number = bm25.packed(pa.table({"terms": [[3, 5], [], [5]], "weights": [[.1, .2], [], [.3]]}))
    assert [x.tolist() for x in number] == [[3, 5], [0, 1, 1], [.1, .2, .3], [0, 2, 2, 3]]


def test_search_drops_its_broadcasts(spark, monkeypatch):
    # a block of queries goes out once for all waves, and executors keep none of it afterwards
    from pyspark import SparkContext
    sent, blocks, plain = [], [], SparkContext.broadcast

    def broadcast(sc, value):
        sent.append(plain(sc, value))
        blocks.extend([value] if isinstance(value, tuple) else [])
        return sent[-1]

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    rows = [(i, f"a b{i % 7} c{i % 11} d{i}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert bm25.top_k(df, F.col("doc_id") % 20 == 0, 3, shard_docs=5).count() == 6 * 3
    assert len(sent) > 2 and not any(b._jbroadcast.isValid() for b in sent)
    assert len(blocks) == 1
