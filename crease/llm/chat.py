r"""Chat formatting in budgeted, turn-aligned windows.  DataFrame functions only.

Template of a turn: ``<s>`` role ``[INST]`` text ``[/INST]</s>``.  Wherever a text
or role holds a mark -- ``<`` or ``[``, any backslashes, the rest of the mark --
one backslash goes behind the first character; reading takes one away.  So no
text can close a turn, and every text comes back as it was.

Windows: turns are put in order (turn, role, text) and their tokens summed up.
The prefix sums choose spans of whole turns within ``budget``.  A window after the
first starts with the system turn (a first turn of that role) and with as many of
the turns before it as fit ``history`` tokens; these repeat only as context.  The
loss mask of a window lists the character spans of its *new* assistant texts, so
each assistant text is a target once.  A turn longer than the budget has a window
of its own; nothing is cut.

The contract hashes a conversation's turns one after another, which makes each
conversation one value in the end; until then rows carry single turns, and the
formatted output one window each.

Edge cases: null texts and roles are empty; null turns come first; equal rows are
turns of their own; a null conv_id is a conversation; an empty table gives no
rows (but the query's conversation -1); other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crease.llm.common import WORD

BUDGET = 512                 # tokens of a window
HISTORY = 128                # tokens of repeated turns before the new ones
MARK_TOKENS = 4              # the marks of a turn
OPEN, ROLE_END, TEXT_END, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
_MARK_REST = r"(/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _MARK_REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _MARK_REST, "$1$2$3")


def turn_tokens(role: Column, text: Column) -> Column:
    """Words of role and text and the marks."""
    return (F.regexp_count(text, F.lit(WORD)) + F.regexp_count(role, F.lit(WORD))
            + MARK_TOKENS).cast("long")


def _render(t: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(t["role"]), F.lit(ROLE_END), escape(t["text"]),
                    F.lit(TEXT_END + CLOSE))


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row a window: conv_id, window, text, first_new (how many turns are
    repeated), loss_spans (code-point spans of the targets in ``text``)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = (turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
            .withColumn("tokens", turn_tokens(F.col("role"), F.col("text")))
            .withColumn("i", F.row_number().over(order))
            .withColumn("upto", F.sum("tokens").over(
                order.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("i", "upto", "tokens", "role", "text"))).alias("turns"))
    system = F.when(F.col("turns")[0]["role"] == "system", F.col("turns")[0]["tokens"]).otherwise(0)
    conv = (conv.withColumn("n_turns", F.size("turns"))
            .withColumn("system_tokens", system)
            .withColumn("later", F.greatest(F.lit(1), F.lit(budget - history) - F.col("system_tokens"))))
    # where windows start: a turn that would overrun the span's budget starts the next one
    start = F.struct(F.array(F.lit(1)).alias("starts"), F.lit(0).cast("long").alias("base"),
                     F.lit(budget).cast("long").alias("room"))

    def step(acc: Column, t: Column) -> Column:
        over = (t["upto"] - acc["base"] > acc["room"]) & (t["i"] > F.element_at(acc["starts"], -1))
        return F.when(over, F.struct(F.concat(acc["starts"], F.array(t["i"])).alias("starts"),
                                     (t["upto"] - t["tokens"]).alias("base"),
                                     F.col("later").cast("long").alias("room"))).otherwise(acc)

    conv = conv.withColumn("starts", F.aggregate("turns", start, step, lambda acc: acc["starts"]))
    w = (conv.select("conv_id", "turns", "n_turns", "system_tokens", "starts",
                     F.posexplode("starts").alias("window", "begin"))
         .withColumn("end", F.coalesce(F.get("starts", F.col("window") + 1), F.col("n_turns") + 1))
         .withColumn("new", F.slice("turns", F.col("begin"), F.col("end") - F.col("begin"))))
    # every turn has MARK_TOKENS tokens at least, which bounds the look back
    back = F.greatest(F.lit(1), F.col("begin") - history // MARK_TOKENS)
    before = F.col("new")[0]["upto"] - F.col("new")[0]["tokens"]
    w = w.withColumn("before", before).withColumn("context", F.filter(
        F.slice("turns", back, F.col("begin") - back),
        lambda t: (F.col("before") - t["upto"] + t["tokens"] <= history)
        & ~((t["i"] == 1) & (F.col("system_tokens") > 0))))
    w = w.withColumn("context", F.when(
        (F.col("window") > 0) & (F.col("system_tokens") > 0),
        F.concat(F.slice("turns", 1, 1), "context")).otherwise(F.col("context")))
    w = (w.withColumn("first_new", F.size("context"))
         .withColumn("shown", F.concat("context", "new"))
         .withColumn("pieces", F.transform("shown", _render)))
    head = F.char_length(F.concat(F.lit(OPEN + ROLE_END), escape(F.lit("assistant"))))
    nothing = F.struct(F.lit(0).cast("long").alias("at"),
                       F.array().cast("array<struct<from:bigint,to:bigint>>").alias("spans"))

    def mark(acc: Column, p: Column) -> Column:
        to = acc["at"] + F.char_length(p["piece"])
        span = F.struct((acc["at"] + head).cast("long").alias("from"),
                        (to - len(TEXT_END + CLOSE)).cast("long").alias("to"))
        return F.struct(to.cast("long").alias("at"), F.when(
            p["target"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    flags = F.transform("shown", lambda t, i: (i >= F.col("first_new")) & (t["role"] == "assistant"))
    marked = F.transform(F.arrays_zip("pieces", "flags"), lambda z: F.struct(
        z["pieces"].alias("piece"), z["flags"].alias("target")))
    return (w.withColumn("flags", flags)
            .select("conv_id", "window", F.array_join("pieces", "").alias("text"), "first_new",
                    F.aggregate(marked, nothing, mark, lambda acc: acc["spans"]).alias("loss_spans")))


def read_turns(windows: DataFrame) -> DataFrame:
    """Windows with ``turns`` -- role and text of every turn, as they were -- parsed
    from the formatted text, and ``loss`` -- the texts under the mask."""
    sealed = F.split("text", CLOSE, -1)
    pieces = F.slice(sealed, 1, F.size(sealed) - 1)
    parsed = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), ROLE_END, 1)).alias("role"),
        unescape(F.substring_index(F.substr(p, F.instr(p, ROLE_END) + len(ROLE_END)), TEXT_END, 1))
        .alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(
        F.substr(F.col("text"), (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int"))))
    return windows.withColumn("turns", parsed).withColumn("loss", loss)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: turns, targets and lengths."""
    w = read_turns(windows)
    new = F.slice("turns", F.col("first_new") + 1, F.size("turns"))
    said = F.array_join(F.transform(new, lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = w.select("conv_id", F.struct(
        "window", F.size(new).cast("long").alias("n"), said.alias("said"),
        F.array_join("loss", "").alias("loss"),
        F.char_length("text").cast("long").alias("chars")).alias("w"))
    whole = part.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    total = lambda f: F.aggregate("ws", F.lit(0).cast("long"), lambda a, x: a + x[f])
    joined = lambda f: F.array_join(F.transform("ws", lambda x: x[f]), "")
    return whole.select(
        F.col("conv_id").cast("long").alias("conv_id"), total("n").alias("n_turns"),
        F.sha2(joined("said").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss").cast("binary"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"))
