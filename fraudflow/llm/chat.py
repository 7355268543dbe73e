"""Chat formatting in budgeted windows (dealt operator 2), DataFrame functions only.

A conversation becomes windows of whole turns.  Prefix sums of the turns'
tokens choose the spans: with ``room`` tokens left beside the system turn and
the repeated history, and ``longest`` the conversation's longest turn, turn i
belongs to span floor(prefix / (room - longest)), which never outgrows the
room.  Where a turn takes more than half the room, spans are ``room`` wide and
a turn across a border is a window of its own.  No step depends on the one
before, so a conversation of any length is cut in parallel.

Template: ``<|role|>text<|end|>`` a turn.  ``&``, ``<`` and ``[`` of texts
(and ``|`` of roles) are escaped as character references, so no control string
can appear inside a turn, and reading back gives the turns exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

BLOCK = 64  # turn numbers that are numbered together
NO_ID = -(1 << 63)
NO_TURN = -(1 << 62)
END = "<|end|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))  # & first, and last when undone


def escape(c: Column) -> Column:
    for raw, safe in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescape(c: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("|"), F.lit("&#124;"))


def unescape_role(c: Column) -> Column:
    return unescape(F.replace(c, F.lit("&#124;"), F.lit("|")))


def byte_tokens(text: Column) -> Column:
    """No fewer tokens than any byte-level tokenizer makes of the escaped text: its UTF-8 bytes.  Three more are the
    template's, whose marks are tokens of their own."""
    return F.octet_length(escape(text)) + 3


def word_tokens(text: Column) -> Column:
    """An estimate for alphabetic scripts: letter or digit runs and other visible characters, plus three for the template.

    Scripts without spaces and unbroken runs take many more tokens than that.
    """
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]")) + 3


def numbered_turns(turns: DataFrame, tokens: Callable[[Column], Column] = byte_tokens) -> DataFrame:
    """cid, rank, role, text, tok, prefix: every turn's place and the tokens before it in its conversation.

    Prefix sums are taken in blocks of turn numbers and over the blocks'
    totals, so a long conversation is not one task.  The system turn (first,
    role ``system``) adds nothing to the prefix.  Nulls: text and role are
    empty, a null turn comes first, rows without conversation are one.
    Equal turn numbers are ordered by role and text.
    """
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN))
    rows = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("cid"), turn.alias("turn"),
        F.floor(turn / BLOCK).alias("block"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tok", tokens(F.col("text")).cast("long"))
    start = rows.groupBy("cid").agg(F.min(F.struct("turn", "role", "text")).alias("s")).select(
        "cid", (F.col("s.role") == "system").alias("led"))
    order = ("turn", "role", "text")
    blocks = rows.groupBy("cid", "block").agg(F.count("*").alias("n"), F.sum("tok").alias("t"))
    before = Window.partitionBy("cid").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(blocks.select("cid", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                                  F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0")), "turn-blocks")
    inside = Window.partitionBy("cid", "block").orderBy(*order)
    rows = rows.select("cid", "block", "role", "text", "tok", (F.row_number().over(inside) - 1).alias("i"),
                       F.coalesce(F.sum("tok").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("t"))
    rows = rows.join(blocks, ["cid", "block"]).join(stored(start, "leads"), "cid")
    rows = rows.select("cid", (F.col("n0") + F.col("i")).alias("rank"), "role", "text", "tok", (F.col("t0") + F.col("t")).alias("prefix"), "led")
    return rows.withColumn("system", F.col("led") & (F.col("rank") == 0)).drop("led")


def chat_windows(turns: DataFrame, budget: int = 4096, history_tokens: int = 1024, history_turns: int = 4, target: str = "assistant",
                 tokens: Callable[[Column], Column] = byte_tokens) -> DataFrame:
    """conv_id, window, text, n_turns, n_repeated, tokens, over_budget, loss_spans.

    ``tokens`` bounds a turn's tokens from above, by default for every script
    (``byte_tokens``), so a window that isn't over_budget keeps the budget; an
    estimate such as ``word_tokens`` fills windows better where it holds.

    ``turns``: conv_id, turn, role, text.  Every turn is new in one window.
    The others repeat the system turn and up to ``history_turns`` turns of at
    most ``history_tokens`` together, which stand first (``n_repeated``).
    ``loss_spans``: character starts and ends in ``text`` of what is new and
    spoken by ``target``; what is repeated is never under the loss.  Windows of
    a conversation are in the order of ``window``; over_budget marks those of
    one turn that doesn't fit by itself.  No turns give no windows.
    """
    rows = stored(numbered_turns(turns, tokens), "turns")
    room = F.greatest(F.lit(1), F.lit(budget - history_tokens) - F.coalesce("lead", F.lit(0)))
    facts = rows.groupBy("cid").agg(F.max(F.when(F.col("system"), F.col("tok"))).alias("lead"), F.max(F.when(~F.col("system"), F.col("tok"))).alias("longest"))
    facts = stored(facts.select("cid", F.coalesce("lead", F.lit(0)).alias("lead"), room.alias("room"), (F.col("longest") * 2 > room).alias("wide"),
                                F.when(F.col("longest") * 2 > room, room).otherwise(room - F.col("longest")).alias("stride")), "conversations")
    at = F.when(F.col("system"), 0).otherwise(F.col("prefix") - F.col("lead"))
    span = F.floor(at / F.col("stride"))
    across = F.col("wide") & ~F.col("system") & (F.floor((at + F.col("tok") - 1) / F.col("stride")) > span)
    fresh = (rows.join(facts.withColumn("stride", F.coalesce("stride", F.lit(1))).withColumn("wide", F.coalesce("wide", F.lit(False))), "cid")
             .withColumn("window", (span * 2 + across.cast("int")).cast("long"))
             .select("cid", "window", "rank", "role", "text", "tok", "prefix", "system", F.lit(False).alias("repeated")))
    fresh = stored(fresh, "spans")
    spans = stored(fresh.groupBy("cid", "window").agg(F.min("rank").alias("first"), F.min("prefix").alias("upto")), "windows")
    # the turns before a window, by their ranks
    back = spans.select("cid", "window", "upto", F.explode(F.sequence(F.lit(1), F.lit(history_turns))).alias("k"), "first")
    back = back.select("cid", "window", "upto", (F.col("first") - F.col("k")).alias("rank")).where("rank >= 0")
    old = rows.select("cid", "rank", "role", "text", "tok", "prefix", "system")
    history = (back.join(old, ["cid", "rank"]).where(~F.col("system") & (F.col("upto") - F.col("prefix") <= history_tokens))
               .select("cid", "window", "rank", "role", "text", "tok", F.lit(True).alias("repeated")))
    lead = (spans.where("first > 0").select("cid", "window").join(stored(old.where("system"), "systems"), "cid")
            .select("cid", "window", "rank", "role", "text", "tok", F.lit(True).alias("repeated")))
    turns_ = fresh.select(*history.columns).unionByName(history).unionByName(lead)

    head = F.concat(F.lit("<|"), escape_role(F.col("role")), F.lit("|>"))
    turns_ = turns_.withColumns({"head": head, "body": escape(F.col("text"))}).withColumn("segment", F.concat("head", "body", F.lit(END)))
    before = Window.partitionBy("cid", "window").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    turns_ = turns_.withColumn("start", F.coalesce(F.sum(F.length("segment")).over(before), F.lit(0)) + F.length("head"))
    mark = F.when(~F.col("repeated") & (F.col("role") == target), F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end")))
    out = turns_.groupBy("cid", "window").agg(
        F.array_sort(F.collect_list(F.struct("rank", "segment", mark.alias("span")))).alias("t"), F.count("*").alias("n_turns"),
        F.sum(F.col("repeated").cast("long")).alias("n_repeated"), F.sum("tok").alias("tokens"))
    return out.select(
        F.when(F.col("cid") != NO_ID, F.col("cid")).alias("conv_id"), "window",
        F.array_join(F.transform("t", lambda t: t["segment"]), "").alias("text"), "n_turns", "n_repeated", "tokens",
        (F.col("tokens") > budget).alias("over_budget"),
        F.filter(F.transform("t", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted text."""
    parts = F.split(text, r"<\|end\|>", -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(parts, _turn)


def _turn(p: Column) -> Column:
    close = F.instr(p, "|>")  # a role holds no |
    return F.struct(unescape_role(F.substr(p, F.lit(3), close - 3)).alias("role"), unescape(F.substr(p, close + 2)).alias("text"))


def read_loss(text: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(F.substr(text, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
