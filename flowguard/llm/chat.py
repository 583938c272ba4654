"""Chat formatting into budgeted, turn-aligned windows with loss masks (DataFrame functions only).

A turn is written ``### role: text</turn>`` and a line feed.  Backslashes, number signs and the slash of
``</`` get a backslash in texts (and colons in roles), so no text can hold a mark and reading reverses it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.common import broadcast_if_small, materialize, text_of, word_count

BUDGET = 1024  #: words of a window, marks included
HISTORY = 256  #: words of earlier turns that a window repeats at most
TARGET = "assistant"  #: role whose texts are trained on
SYSTEM = "system"  #: role of a first turn that every window retains
END = "</turn>\n"
MARKS = 3  #: words that the marks of a turn count


def escape(text: Column, more: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#{more}]|(?<=<)/)", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Windows of ``turns(conv_id, turn, role, text)``.

    Returns ``conv_id, window, n_context, text, mask (array of start, length in code points), n_words``.  A
    window holds the conversation's system turn, earlier turns of at most ``history`` words, and new turns;
    the first ``n_context`` turns are repeated ones and carry no loss, so each target is masked in exactly
    once.  Prefix sums of the turns' words choose the spans: a window takes new turns while it stays within
    ``budget``; one turn above it makes a window of its own, with no history, and is never cut.

    Null roles and texts count as empty; turns order by turn (null first), role and text; repeated rows are
    turns of their own; null conv_id is a conversation of its own; an empty table gives no windows; other
    columns are ignored.  A row holds the turns of one window, never those of a conversation; only running sums
    go through one conversation's turns in a single task.
    """
    role, text = text_of("role"), text_of("text")
    head = F.concat(F.lit("### "), escape(role, ":"), F.lit(": "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("raw"), head.alias("head"), escape(text).alias("body"),
                        (word_count("text") + MARKS).alias("words"))
    rows = rows.select("conv_id", "turn", "role", "raw", "words", F.concat("head", "body", F.lit(END)).alias("out"),
                       F.char_length("head").alias("skip"), F.char_length("body").alias("long"))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "raw")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(
        "conv_id", (F.row_number().over(w) - 1).alias("at"), (F.sum("words").over(upto) - F.col("words")).alias("before"), "words",
        (F.sum(F.char_length("out")).over(upto) - F.char_length("out")).alias("offset"), "role", "out", "skip", "long",
        (F.first("role").over(upto) == SYSTEM).cast("int").alias("sys"), F.first("words").over(upto).alias("first_words"))
    spans = _spans(rows, budget, history)
    # the turns of a window, its history included, and the system turn that it repeats
    wanted = spans.select("conv_id", "window", "s", "h", "sys", F.explode(F.concat(
        F.when((F.col("s") > 0) & (F.col("sys") == 1), F.array(F.lit(0))).otherwise(F.array().cast("array<int>")),
        F.sequence(F.col("h"), F.col("e") - 1))).alias("nth"))
    turn = rows.select(F.col("conv_id").alias("of"), F.struct("at", "words", "offset", "role", "out", "skip", "long").alias("t"))
    parts = wanted.join(turn, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("nth") == F.col("t.at")))
    one = parts.groupBy("conv_id", "window", "s", "h", "sys").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    one = one.withColumn("kept", F.expr("if(s > 0, sys, 0)"))
    return one.select(
        "conv_id", "window", (F.col("s") - F.col("h") + F.col("kept")).alias("n_context"),
        F.array_join(F.transform("ts", lambda x: x["out"]), "").alias("text"),
        F.expr(f"""transform(filter(ts, x -> x.at >= s AND x.role = '{TARGET}'), x -> struct(
            if(kept = 1, char_length(ts[0].out), 0) + x.offset - ts[kept].offset + x.skip AS start, x.long AS length))""").alias("mask"),
        F.expr("aggregate(slice(ts, kept + 1, size(ts)), 0L, (n, x) -> n + x.words)").alias("n_words"))


def _spans(rows: DataFrame, budget: int, history: int) -> DataFrame:
    """Windows ``conv_id, window, s (first new turn), h (first turn of the history), e (turn after the last), sys``.

    Every turn gets the start that would follow if a window began there, from the turns within reach of
    ``history`` and ``budget`` words (each counts ``MARKS`` at least).  The starts really taken are those that
    the first turn leads to, found by doubling the steps: as many rounds as the logarithm of the most windows.
    """
    w = Window.partitionBy("conv_id")
    t = rows.select("conv_id", "at", "before", (F.col("before") + F.col("words")).alias("upto"), "sys",
                    (F.col("sys") * F.col("first_words")).alias("sys_words"))
    t = t.withColumn("back", F.collect_list("before").over(w.orderBy("before").rangeBetween(-int(history), 0)))
    t = t.withColumn("ahead", F.collect_list("upto").over(w.orderBy("upto").rangeBetween(0, int(budget))))
    t = t.withColumn("turns", F.count("*").over(w))
    far = F.expr(f"""at + 1 - size(filter(back, b -> b >= greatest(before - {int(history)}, upto + sys_words - {int(budget)})))""")
    t = t.withColumn("h", F.when(F.col("at") == 0, 0).otherwise(F.greatest("sys", F.least("at", far))).cast("int"))
    t = t.withColumn("base", F.expr("back[h - (at + 1 - size(back))]"))
    t = t.withColumn("e", F.expr(f"at + greatest(1, size(filter(ahead, u -> u <= {int(budget)} + base - if(at > 0, sys_words, 0))))").cast("int"))
    t = materialize(t.select("conv_id", "at", "h", "e", "sys", "turns"))
    hop = t.where("e < turns").select(F.col("conv_id").alias("of"), F.col("at").alias("from"), F.col("e").alias("to"))
    starts = t.where("at = 0").select("conv_id", F.col("at").alias("s"))
    while True:
        hop = broadcast_if_small(hop, 40)
        if hop.isEmpty():
            break
        more = starts.join(hop, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("s") == F.col("from"))).select("conv_id", F.col("to").alias("s"))
        starts = materialize(starts.unionByName(more).repartition("conv_id", "s"))  # a union adds up partitions
        then = hop.select(F.col("of").alias("of2"), F.col("from").alias("from2"), F.col("to").alias("to2"))
        hop = hop.join(then, F.col("of").eqNullSafe(F.col("of2")) & (F.col("to") == F.col("from2"))).select("of", "from", F.col("to2").alias("to"))
    starts = starts.select(F.col("conv_id").alias("of"), "s")
    taken = t.join(starts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("at") == F.col("s")))
    number = (F.row_number().over(w.orderBy("s")) - 1).alias("window")
    return taken.select("conv_id", number, "s", "h", F.least("e", "turns").cast("int").alias("e"), "sys")


def read_windows(windows: DataFrame) -> DataFrame:
    """Turns and masked texts of each window, read from its text and mask: ``conv_id, window, turns, targets``.

    turns: array of (role, text) without the repeated ones; targets: the unescaped texts under the mask.
    """
    found = F.expr("slice(split(text, '</turn>\\n', -1), n_context + 1, size(split(text, '</turn>\\n', -1)) - 1 - n_context)")
    mark = r"(?s)^### ((?:[^:\\]|\\.)*): (.*)$"
    return windows.select(
        "conv_id", "window", F.char_length("text").alias("chars"),
        F.transform(found, lambda t: F.struct(unescape(F.regexp_extract(t, mark, 1)).alias("role"),
                                              unescape(F.regexp_extract(t, mark, 2)).alias("text"))).alias("turns"),
        F.transform("mask", lambda m: unescape(F.substring("text", m["start"].cast("int") + 1, m["length"]))).alias("targets"))


def conversation_digests(read: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows."""
    each = read.select(
        "conv_id", "chars", F.size("turns").alias("n"), F.struct(
            "window", F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
            F.array_join("targets", "").alias("loss")).alias("w"))
    one = each.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
                                      F.count("*").alias("n_windows"), F.array_sort(F.collect_list("w")).alias("ws"))
    said = F.array_join(F.transform("ws", lambda x: x["said"]), "")
    loss = F.array_join(F.transform("ws", lambda x: x["loss"]), "")
    return one.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
                      F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
                      F.col("formatted_chars").cast("long").alias("formatted_chars"), "n_windows")
