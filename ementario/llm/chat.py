"""Chat formatting into budgeted windows of whole turns, with a mask over what is to be learnt.

Prefix sums of turn tokens cut a conversation into spans: a turn belongs to the span in which it begins.
A window is the system turn, the last turns before the span as history, and the span. Texts of the assistant
in the span are the targets; in the history they are repeated and masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ementario.session import materialize

OPEN, SEP, CLOSE = "<turn ", ">\n", "</turn>\n"
#: Turns are added up in blocks of so many turn numbers, so that a long conversation is many groups.
BLOCK = 512


def escape(text: Column) -> Column:
    r"""Reversible: ``\`` becomes ``\b``, ``<`` becomes ``\l`` and ``>`` becomes ``\g``, so no marker can occur."""
    out = F.coalesce(text, F.lit(""))
    for plain, coded in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column) -> Column:
    out = text
    for coded, plain in (("\\g", ">"), ("\\l", "<"), ("\\b", "\\")):
        out = F.replace(out, F.lit(coded), F.lit(plain))
    return out


def marked_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escape(role), F.lit(SEP), escape(text), F.lit(CLOSE))


def turn_tokens(role: Column, text: Column) -> Column:
    """The bytes of the turn as it is written: no tokenizer that works on bytes makes more tokens of it."""
    return F.octet_length(marked_turn(role, text))


def place_turns(turns: DataFrame) -> DataFrame:
    """conv_id, seq, role, text, tokens and ``start``: the tokens of the conversation before the turn.

    Turns are ordered by (turn, role, text), null turns first; a turn that occurs twice stays twice. Sums are made
    per block of turn numbers and then over the blocks, so no task holds a whole long conversation.
    """
    block = F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-1 << 40))
    base = turns.select(
        "conv_id", "turn", block.alias("block"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), turn_tokens(F.col("role"), F.col("text")).cast("long").alias("tokens"),
    )
    within = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    here = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = base.withColumns({
        "in_block": F.coalesce(F.sum("tokens").over(here), F.lit(0)), "n_block": F.row_number().over(within) - 1,
    })
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = base.groupBy("conv_id", "block").agg(F.sum("tokens").alias("sum"), F.count("*").alias("cnt")).select(
        F.col("conv_id").alias("c"), F.col("block").alias("b"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("cnt").over(earlier), F.lit(0)).alias("n_before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    return placed.join(blocks, same).select(
        "conv_id", (F.col("n_before") + F.col("n_block")).alias("seq"), "role", "text", "tokens",
        (F.col("before") + F.col("in_block")).alias("start"),
    )


def format_windows(turns: DataFrame, budget: int = 2048, history: int = 256) -> DataFrame:
    """One row per training window: conv_id, window, formatted, n_context, n_turns and loss_spans.

    ``formatted`` is the text; its first ``n_context`` turns repeat the system turn and the history. ``loss_spans`` is an
    array of (start, length) in characters: the texts of the assistant that this window teaches. Spans take half of
    what the system turn and ``history`` leave of ``budget``, so that windows of turns no longer than such a
    half stay within the budget; a longer turn is never cut. Null roles and texts are empty.
    """
    placed = materialize(place_turns(turns), "chat-turns")
    system = placed.where("role = 'system'").groupBy("conv_id").agg(
        F.min(F.struct("seq", "text", "tokens")).alias("s")
    ).select(F.col("conv_id").alias("c"), "s")
    width = F.greatest(F.lit(64), F.floor((budget - history - F.coalesce(F.col("s.tokens"), F.lit(0))) / 2))
    joined = placed.join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left").withColumn("width", width)
    window = F.floor(F.col("start") / F.col("width"))
    is_system = F.coalesce(F.col("seq") == F.col("s.seq"), F.lit(False))
    # A turn also ends the history of the next window if it begins in the last tokens before it.
    in_history = ~is_system & (F.col("start") >= (window + 1) * F.col("width") - history)
    uses = F.when(in_history, F.array(F.struct(window.alias("w"), F.lit(2).alias("part")),
                                      F.struct((window + 1).alias("w"), F.lit(1).alias("part"))))
    uses = uses.otherwise(F.array(F.struct(window.alias("w"), F.lit(2).alias("part"))))
    marked = marked_turn(F.col("role"), F.col("text"))
    head = F.char_length(F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(SEP)))
    used = joined.select(
        "conv_id", F.explode(uses).alias("u"), "seq", marked.alias("marked"), head.alias("head"),
        F.char_length(escape(F.col("text"))).alias("len"), (F.col("role") == "assistant").alias("target"), "s",
        window.alias("own"), F.when(is_system, window).alias("sys_in"),
    )
    # Bounded by the budget: every turn has tokens, also an empty one.
    grouped = used.groupBy("conv_id", F.col("u.w").alias("window")).agg(
        F.array_sort(F.collect_list(F.struct("u.part", "seq", "marked", "head", "len", "target"))).alias("turns"),
        F.max("sys_in").alias("sys_in"), F.max("s").alias("s"), F.max("u.part").alias("top"),
    ).where("top = 2")  # the history alone makes no window
    repeated = F.concat(F.lit(OPEN + "system" + SEP), escape(F.col("s.text")), F.lit(CLOSE))
    # The system turn leads every later window; its own window, and those before it, have it in its place.
    leads = F.col("s").isNotNull() & F.col("sys_in").isNull()
    prefix = F.when(leads, repeated).otherwise(F.lit(""))
    sums = F.aggregate(
        "turns",
        F.struct(F.char_length(prefix).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["marked"])).alias("at"),
            F.when(t["target"] & (t["part"] == 2), F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + t["head"]).alias("start"), t["len"].alias("length")
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    context = F.size(F.filter("turns", lambda t: t["part"] == 1)) + F.when(leads, 1).otherwise(0)
    return grouped.select(
        "conv_id", "window", F.concat(prefix, F.array_join(F.transform("turns", lambda t: t["marked"]), "")).alias("formatted"),
        context.alias("n_context"), (F.size("turns") + F.when(leads, 1).otherwise(0)).alias("n_turns"),
        sums["spans"].alias("loss_spans"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """Per window, from the formatted text alone: the new turns (role, text) in order and the texts under the mask."""
    pieces = F.filter(F.split("formatted", CLOSE, -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(OPEN) + 1, F.char_length(piece))
        at = F.locate(SEP, body)
        return F.struct(
            unescape(F.substring(body, F.lit(1), at - 1)).alias("role"),
            unescape(F.substring(body, at + len(SEP), F.char_length(body))).alias("text"),
        )

    new = F.slice(pieces, F.col("n_context") + 1, F.greatest(F.size(pieces) - F.col("n_context"), F.lit(0)))
    loss = F.transform(
        "loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))
    )
    return windows.select(
        "conv_id", "window", F.transform(new, turn).alias("turns"), loss.alias("loss"),
        F.char_length("formatted").cast("long").alias("chars"),
    )


def digests(read: DataFrame) -> DataFrame:
    """Per conversation: turns and loss text as counted and hashed. A hash needs the whole text of its conversation,
    so each window is first joined to one string and the group holds these strings, one per window."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    strings = read.select(
        "conv_id", "window", F.size("turns").alias("n"), turns.alias("turns"), F.array_join("loss", "").alias("loss"), "chars"
    )
    grouped = strings.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("all"),
    )

    def joined(field: str) -> Column:
        return F.array_join(F.transform("all", lambda x: x[field]), "")

    return grouped.select(
        "conv_id", "n_turns", F.sha2(joined("turns").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(joined("loss")).cast("long").alias("loss_chars"),
        F.sha2(joined("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
