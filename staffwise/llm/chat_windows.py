"""Chat formatting in budgeted windows, in DataFrame functions only.

A conversation's turns are rendered one after the other; long conversations
are cut into windows of whole turns that fit a token budget.

1. Turn tokens are counted (pieces of up to eight characters of a word, and
   ``TURN_TOKENS`` for the marks), and prefix sums run over each conversation.
2. The sums fall into buckets as wide as the room that the system turn and the
   history leave. Turns inside one bucket make a window; a turn that crosses a
   border is a window of its own. So a window keeps the budget unless one turn
   alone, or the system turn, is too long for it, and a turn's window follows
   from its own prefix sum: nothing is packed one by one.
3. Every later window starts with the system turn (the first turn, if it has
   that role) and the last turns of the window before it, as far as the
   history budget goes.
4. The loss mask covers the assistants' own turns; repeated turns are masked
   out, so each assistant text is a target once.

A turn is ``<s>role[INST]text[/INST]</s>``. Control strings inside roles and
texts are broken by a backslash after their first character, and backslashes
are doubled; ``unescaped`` reverts both.

What is collected is a window: at most the budget, or one long turn. Turns of
one conversation are ordered by one task (a window function that spills);
``conversation_digests`` needs each whole conversation in one cell, as its
digests are taken over it.

Defined results: null role and null text count as empty; turns of one number
are ordered by role, then text, a null turn comes last; repeated rows are turns
like any other; null conversation ids form one conversation. Extra columns are
ignored. Empty in, empty out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template's control strings.
BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = [BEGIN, OPEN, CLOSE, END]
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"
BUDGET = 512
HISTORY = 96
TURN_TOKENS = 4
TOKEN = r"[^\x20\x09-\x0D]{1,8}"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROL, doubled)


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)) + TURN_TOKENS


def _in_windows(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """The turns with the number of their window and their prefix sums (the system turn counts in none)."""
    upto = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), "role", "text")
    first_system = F.first(F.col("role") == SYSTEM_ROLE).over(upto)
    is_system = F.col("first_system") & (F.col("pos") == 1)
    room = F.greatest(F.lit(budget - history) - F.when(F.col("first_system"), F.col("first_tokens")).otherwise(0), F.lit(max(1, budget // 4)))
    counted = (
        turns.withColumn("tokens", turn_tokens(F.col("text")).cast("long"))
        .select("*", F.row_number().over(upto).alias("pos"), first_system.alias("first_system"), F.first("tokens").over(upto).alias("first_tokens"))
        .withColumns({"is_system": is_system, "room": room})
        .withColumn("upto", F.sum(F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))).over(upto))
        .withColumn("bucket", F.struct(F.expr("(upto - tokens) div room").alias("low"), F.expr("(upto - 1) div room").alias("high")))
    )
    opens = ~F.lag("is_system", 1, True).over(upto) & (F.lag("bucket").over(upto) != F.col("bucket"))
    system_text = F.first("text").over(upto)
    return (
        counted.withColumn("opens", F.when(F.col("pos") == 1, F.lit(False)).otherwise(opens))
        .withColumn("window", (F.sum(F.col("opens").cast("int")).over(upto) + 1).cast("int"))
        .withColumn("system_text", F.when(F.col("opens") & F.col("first_system"), system_text))
        .withColumn("ends_at", F.max("upto").over(Window.partitionBy("conv_id", "window")))
        .withColumn("recent", ~F.col("is_system") & (F.col("ends_at") - F.col("upto") + F.col("tokens") <= history))
    )


def format_chats(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """One row per window: conv_id, window, formatted, n_repeated (leading turns that stand in an earlier
    window), loss_spans (code points of ``formatted``, end exclusive), n_tokens."""
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    place = lambda window, repeated: F.struct(window.alias("window"), F.lit(repeated).alias("repeated"))
    own, again = place(F.col("window"), False), place(F.col("window") + 1, True)
    placed = _in_windows(turns, budget, history).withColumn("at", F.explode(F.when(F.col("recent"), F.array(own, again)).otherwise(F.array(own))))
    head = lambda role: F.concat(F.lit(BEGIN), escaped(role), F.lit(OPEN))
    turn = F.struct(
        "pos", F.col("at.repeated").alias("repeated"), head(F.col("role")).alias("head"), escaped(F.col("text")).alias("body"),
        "tokens", ((F.col("role") == TARGET_ROLE) & ~F.col("at.repeated")).alias("target"),
    )
    windows = placed.groupBy("conv_id", F.col("at.window").alias("window")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"),
        F.first(F.when(~F.col("at.repeated"), F.col("system_text")), ignorenulls=True).alias("system_text"),
        F.first("first_tokens").alias("first_tokens"),
    )
    windows = windows.where(F.exists("turns", lambda t: ~t["repeated"]))  # no window of history alone follows the last one
    system = F.struct(
        F.lit(0).alias("pos"), F.lit(True).alias("repeated"), head(F.lit(SYSTEM_ROLE)).alias("head"), escaped(F.col("system_text")).alias("body"),
        F.col("first_tokens").alias("tokens"), F.lit(False).alias("target"),
    )
    windows = windows.withColumn("turns", F.when(F.col("system_text").isNotNull(), F.concat(F.array(system), "turns")).otherwise(F.col("turns")))
    tail = CLOSE + END
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["head"]) + F.char_length(t["body"]) + len(tail)).alias("at"),
            F.when(
                t["target"],
                F.concat(acc["spans"], F.array(F.struct(
                    (acc["at"] + F.char_length(t["head"])).alias("start"), (acc["at"] + F.char_length(t["head"]) + F.char_length(t["body"])).alias("end")
                ))),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return windows.select(
        "conv_id", "window",
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "").alias("formatted"),
        F.size(F.filter("turns", lambda t: t["repeated"])).alias("n_repeated"),
        spans.alias("loss_spans"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("n_tokens"),
    )


def read_turns(windows: DataFrame) -> DataFrame:
    """The windows with what their formatted text holds: ``turns`` (role, text; all, repeated ones first) and
    ``targets`` (texts under the loss mask), unescaped."""
    marked = F.split("formatted", F.lit(r"\Q" + CLOSE + END + r"\E"))
    body = lambda t: F.substr(t, F.instr(t, OPEN) + len(OPEN))
    turn = lambda t: F.struct(
        unescaped(F.substr(F.substring_index(t, OPEN, 1), F.lit(len(BEGIN) + 1))).alias("role"), unescaped(body(t)).alias("text")
    )
    return windows.withColumns({
        "turns": F.transform(F.slice(marked, F.lit(1), F.size(marked) - 1), turn),
        "targets": F.transform("loss_spans", lambda s: unescaped(F.substr("formatted", s["start"] + 1, s["end"] - s["start"]))),
    })


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows: each turn and each target once."""
    own = F.expr("slice(turns, n_repeated + 1, size(turns))")
    part = F.struct("window", own.alias("turns"), "targets", F.char_length("formatted").cast("long").alias("chars"))
    whole = read_turns(windows).groupBy("conv_id").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    turns, loss = F.flatten(F.col("parts.turns")), F.array_join(F.flatten(F.col("parts.targets")), "")
    told = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["chars"]).alias("formatted_chars"),
    )
