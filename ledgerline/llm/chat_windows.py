"""Chat formatting into windows of a token budget, by prefix sums over the turns; native expressions only.

A turn is written ``<|im_start|>role``, a line feed, its text, ``<|im_end|>`` and a line feed. Control strings in texts are escaped: ``<`` and
``|`` with k backslashes between become ones with k + 1, so ``<|`` never stands in a written text and unescaping takes one backslash away. In roles backslash,
line feed and ``|`` become ``\\\\``, ``\\n`` and ``\\p``.

A turn's tokens are the words and single marks of its text plus ``OVERHEAD`` for the template; ``before`` is the sum over the conversation's earlier turns. Each turn is new in one window:
the next window starts where its turns would exceed what the budget leaves beside the system turn (a conversation's first row, if its role is
``system``) and the history. Every window starts with the system turn, then repeats the latest earlier turns that start at most ``history`` tokens before its
first new one, fewer where its new turns need the room. The loss mask covers the assistants' texts among the new turns, so a target that is repeated as history is masked out. Texts are never
cut: a turn too long for the budget has a window of its own, without history.

Conversations of any length: turns are range-partitioned for the prefix sums (``ordering.positions``); stretches of ``STRETCH`` budgets
of tokens, cut by the prefix sums, are then packed one by one, so a hot conversation is many tasks and no task holds more than a stretch, what history
reaches into it, and one turn over its end. No window crosses the end of a stretch.

Turns are taken by turn number, nulls last; rows of one number by a hash of role and text. Null texts and roles are empty. Repeated rows are turns of their
own. A null conversation id is a conversation. An empty table gives no windows. Only the four columns named are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.ordering import positions

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 2048
HISTORY = 256
#: Tokens of the template around a text.
OVERHEAD = 4
#: Budgets in a stretch.
STRETCH = 8
SYSTEM, TARGET = "system", "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("|"), F.lit("\\p"))


def unescape_role(role: Column) -> Column:
    plain = F.transform(F.split(role, r"\\\\"), lambda part: F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\p"), F.lit("|")))
    return F.array_join(plain, "\\")


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, b: a + b)


def turns(chats: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, tokens: Callable[[Column], Column]) -> DataFrame:
    """(conv_id, position in the conversation, before, tokens, target, system, piece: the written turn, lead and size: code points up to its text and in it)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    rows = chats.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"))
    size = tokens(F.col("text")) + OVERHEAD
    placed = positions(rows, ["conv_id"], [F.col("turn").asc_nulls_last(), F.xxhash64("role", "text")], {"position": F.lit(1), "before": size}, "turns")
    head, body = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")), escape(F.col("text"))
    return placed.select("conv_id", "position", "before", size.alias("tokens"), (F.col("role") == TARGET).alias("target"),
                         ((F.col("position") == 0) & (F.col("role") == SYSTEM)).alias("system"),
                         F.concat(head, body, F.lit(END + "\n")).alias("piece"), F.length(head).alias("lead"), F.length(body).alias("size"))


def windows(chats: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", tokens: Callable[[Column], Column] = count_tokens) -> DataFrame:
    """A row a window: conv_id, first_turn (position of its first new turn), repeated (turns before it, which other windows hold), n_turns (all of
    it), tokens, formatted, loss (spans ``start``, ``end`` of code points of ``formatted``, end exclusive)."""
    length = STRETCH * budget
    rows = turns(chats, conv_col, turn_col, role_col, text_col, tokens)
    fields = ["position", "before", "tokens", "target", "piece", "lead", "size"]
    body = rows.where(~F.col("system"))
    stretch = F.expr(f"before div {length}")
    entry = lambda own: F.struct(*fields, F.lit(own).alias("own"))
    reaches = F.col("before") >= (stretch + 1) * length - history  # into the next stretch
    own = F.struct(stretch.alias("stretch"), entry(True).alias("turn"))
    passed = F.when(reaches, F.struct((stretch + 1).alias("stretch"), entry(False).alias("turn")))
    body = body.select("conv_id", F.explode(F.array_compact(F.array(own, passed))).alias("x")).select("conv_id", "x.*")
    # a copy of the system turn for each stretch of its conversation
    last = rows.groupBy("conv_id").agg(F.max(stretch).alias("last"), F.count("*").alias("rows")).withColumnRenamed("conv_id", "of")
    system = rows.where("system").join(last, F.col("conv_id").eqNullSafe(F.col("of")))
    system = system.select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("stretch"), F.struct("piece", "tokens", "rows").alias("system"))
    both = body.withColumn("system", F.lit(None).cast(system.schema["system"].dataType)).unionByName(system.withColumn("turn", F.lit(None).cast(body.schema["turn"].dataType)))
    held = both.groupBy("conv_id", "stretch").agg(F.array_sort(F.collect_list("turn")).alias("turns"), F.first("system", ignorenulls=True).alias("system"))
    held = held.withColumn("own", F.filter("turns", lambda t: t["own"]))
    taken = F.coalesce(F.col("system.tokens"), F.lit(0))
    room = F.lit(budget - history) - taken

    def pack(state: Column, turn: Column) -> Column:
        full = turn["before"] + turn["tokens"] - state["start"] > room
        return F.when((state["at"] > 0) & full, F.struct((state["at"] + 1).alias("at"), turn["before"].alias("start"), F.array_append(state["cuts"], state["at"]).alias("cuts"))) \
            .otherwise(F.struct((state["at"] + 1).alias("at"), state["start"].alias("start"), state["cuts"].alias("cuts")))

    start = F.struct(F.lit(0).alias("at"), F.get("own", F.lit(0))["before"].alias("start"), F.array(F.lit(0)).alias("cuts"))
    held = held.withColumn("cuts", F.when(F.size("own") > 0, F.aggregate("own", start, pack, lambda s: s["cuts"])).otherwise(F.array().cast("array<int>")))
    whole = F.col("own")

    def window(new: Column) -> Column:
        first, end = F.get(new, F.lit(0)), F.get(new, F.size(new) - 1)
        spent = end["before"] + end["tokens"] - first["before"]
        reach = F.least(F.lit(history), F.lit(budget) - taken - spent)
        before = F.filter("turns", lambda t: (t["position"] < first["position"]) & (t["before"] >= first["before"] - reach))
        return _let(F.struct(new.alias("new"), before.alias("before"), spent.alias("spent")), written)

    def written(w: Column) -> Column:
        new, before = w["new"], w["before"]
        opening = F.coalesce(F.col("system.piece"), F.lit(""))
        first = F.get(new, F.lit(0))["position"]
        with_system = F.col("system").isNotNull()
        begins = with_system & (first == 1)  # the window that the system turn is new in
        joined = lambda ts: F.array_join(F.transform(ts, lambda t: t["piece"]), "")
        ahead = F.length(opening) + _total(F.transform(before, lambda t: F.length(t["piece"]).cast("long")))

        def mask(state: Column, t: Column) -> Column:
            at = state["at"] + t["lead"]
            span = F.struct(at.alias("start"), (at + t["size"]).alias("end"))
            return F.struct((state["at"] + F.length(t["piece"])).alias("at"), F.when(t["target"], F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

        empty = F.struct(ahead.alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
        return F.struct(F.when(begins, 0).otherwise(first).cast("long").alias("first_turn"),
                        F.when(begins, 0).otherwise(with_system.cast("int") + F.size(before)).alias("repeated"),
                        (with_system.cast("int") + F.size(before) + F.size(new)).alias("n_turns"),
                        (taken + _total(F.transform(before, lambda t: t["tokens"])) + w["spent"]).alias("tokens"),
                        F.concat(opening, joined(before), joined(new)).alias("formatted"), F.aggregate(new, empty, mask, lambda s: s["spans"]).alias("loss"))

    def cut(c: Column, k: Column) -> Column:
        till = F.coalesce(F.get("cuts", k + 1), F.size(whole))
        return _let(F.slice(whole, c + 1, till - c), window)

    alone = F.struct(F.lit(0).cast("long").alias("first_turn"), F.lit(0).alias("repeated"), F.lit(1).alias("n_turns"), taken.cast("long").alias("tokens"),
                     F.col("system.piece").alias("formatted"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))
    made = F.when(F.col("system.rows") == 1, F.array(alone)).otherwise(F.transform("cuts", cut))
    return held.select("conv_id", F.explode(made).alias("w")).select("conv_id", "w.*")


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped."""
    def turn(piece: Column) -> Column:
        return _let(F.substring_index(piece, "\n", 1), lambda head: F.struct(
            unescape_role(head).alias("role"),
            unescape(F.substr(piece, F.length(head) + 2, F.length(piece) - F.length(head) - 1 - len(END + "\n"))).alias("text")))

    pieces = F.split(formatted, r"<\|im_start\|>")
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def read_back(made: DataFrame) -> DataFrame:
    """Per conversation, from the windows' texts and masks alone: conv_id, n_turns, turns_sha256 (of role, line feed, text, line feed of each
    turn once), loss_chars and loss_sha256 (of the text under the mask), formatted_chars, n_windows.

    The digests are of a conversation's whole text, so a task holds the whole conversation here, unlike in ``windows``.
    """
    turn_list = F.col("turns")
    new = F.slice(turn_list, F.col("repeated") + 1, F.size(turn_list))
    lines = F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    under = F.array_join(F.transform("loss", lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
    rows = made.withColumn("turns", parsed(F.col("formatted")))
    rows = rows.select("conv_id", F.struct("first_turn", F.size(new).alias("n"), lines.alias("lines"), under.alias("under"), F.length("formatted").alias("chars")).alias("w"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("ws"))
    loss = F.array_join(F.transform("ws", lambda w: w["under"]), "")
    return whole.select("conv_id", _total(F.transform("ws", lambda w: w["n"].cast("long"))).alias("n_turns"),
                        F.sha2(F.array_join(F.transform("ws", lambda w: w["lines"]), ""), 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        _total(F.transform("ws", lambda w: w["chars"].cast("long"))).alias("formatted_chars"), F.size("ws").cast("long").alias("n_windows"))
