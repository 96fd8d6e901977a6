"""Chat formatting in budgeted, turn-aligned windows. DataFrame functions only.

Prefix sums of turn tokens cut a conversation into spans: a turn belongs to the
span its first token falls into, spans are ``stride`` tokens apart. A turn that
would leave too short a stride is over-long: it is a span of its own and does not
count in the stride. The stride leaves room for the longest other turn, the
system turn and the repeated history, so a window keeps the budget wherever its
turns can; a turn is never cut. A window holds the system turn (if an earlier
span has it), the last turns before its first one within the history allowance,
whatever span they are in, and its own turns. Only assistant texts of own turns
are under the loss mask, so each is learned from once.

Control strings inside texts and roles get a backslash after their first
character, and backslashes are doubled, so no text can end or open a turn and
``unescaped`` restores it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.scan import Running, running, time_block
from tidewatch.llm.common import row_key

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
CONTROLS = (OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
ROLE_SYSTEM, ROLE_TARGET = "system", "assistant"
BUDGET = 1024
HISTORY = 256
# Turns scanned in one piece when prefix sums are made.
BLOCK = 4096
_NO_CONV = -(2**63) + 1


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def tokens(segment: Column) -> Column:
    """Estimated tokens of a formatted turn: four bytes each, rounded up."""
    return F.ceil(F.octet_length(segment) / 4).cast("long")


def turns(conversations: DataFrame, room: int, slack: int) -> DataFrame:
    """Turns in order with their formatted segment and token prefix sums.

    ``_over`` marks turns that leave less than ``slack`` of ``room`` beside the
    system turn; ``_own`` sums the tokens of the others, ``_overs`` counts them.
    A system turn that has no place in ``room`` takes none of it.
    """
    rows = conversations.select(
        row_key("conv_id").alias("_c"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(2**62))).alias("_turn"),
        F.coalesce("role", F.lit("")).alias("_role"),
        F.coalesce("text", F.lit("")).alias("_text"),
    )
    head = F.concat(F.lit(OPEN), F.replace(escaped(F.col("_role")), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))
    rows = rows.withColumns({"_head": head, "_body": escaped(F.col("_text"))})
    rows = rows.withColumn("_seg", F.concat("_head", "_body", F.lit(f"{CLOSE}\n"))).withColumn("_n", tokens(F.col("_seg")))
    system = rows.where(F.col("_role") == ROLE_SYSTEM).groupBy("_c").agg(F.min(F.struct("_turn", "_role", "_text", "_n")).getField("_n").alias("_sys_n"))
    rows = rows.join(system, "_c", "left").withColumn("_room", F.lit(room) - F.when(F.col("_sys_n") < room, F.col("_sys_n")).otherwise(0)).drop("_sys_n")
    rows = rows.withColumn("_over", F.col("_n") > F.col("_room") - slack + 1)
    one = F.lit(1).cast("long")
    return running(
        rows, ["_c"], ["_turn", "_role", "_text"], time_block("_turn", BLOCK),
        {
            "_end": Running("sum", F.col("_n")), "_pos": Running("sum", one),
            "_own": Running("sum", F.when(F.col("_over"), one * 0).otherwise(F.col("_n"))),
            "_overs": Running("sum", F.when(F.col("_over"), one).otherwise(one * 0)),
        },
    )


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, n_repeated, loss_spans) with spans in code points of ``formatted``.

    Turns are ordered by turn, role and text; null turns come first, repeated
    rows are turns of their own. Null roles and texts are empty. Rows without
    conv_id form one conversation. ``n_repeated`` leading turns of a window are
    repeats. Extra columns are not read; an empty table gives no windows.
    """
    room = budget - history
    base = turns(conversations, room, max(1, min(history, room // 2)))
    over = F.col("_over").cast("long")
    base = base.withColumns({"_before": F.col("_own") - F.col("_n") * (1 - over), "_shift": 2 * F.col("_overs") - over})
    first_system = F.min(F.when(F.col("_role") == ROLE_SYSTEM, F.struct("_pos", "_seg", "_before", "_shift")))
    longest = F.coalesce(F.max(F.when(~F.col("_over"), F.col("_n"))), F.lit(0))
    whole = base.groupBy("_c").agg(F.greatest(F.max("_room") - longest + 1, F.lit(1)).alias("_stride"), first_system.alias("_sys"))
    placed = base.drop("_room").join(whole, "_c").withColumn("_at", F.col("_end") - F.col("_n"))
    # An over-long turn moves itself on by one span and what follows by another.
    span = lambda at: F.floor(F.try_divide(f"{at}_before", "_stride")).cast("long") + F.col(f"{at}_shift")
    placed = placed.withColumns({"_span": span(""), "_sys_span": span("_sys.")})
    own = placed.select(
        "_c", "_span", F.lit(2).alias("part"), "_pos", "_seg", F.length("_head").alias("head"),
        F.when(F.col("_role") == ROLE_TARGET, F.length("_body")).alias("target"),
    )
    starts = placed.groupBy("_c", "_span").agg(F.min("_at").alias("_start"), F.first("_sys").alias("_sys"), F.first("_sys_span").alias("_sys_span"))
    none = [F.lit(0).alias("head"), F.lit(None).cast("int").alias("target")]
    system = starts.where("_span > _sys_span").select("_c", "_span", F.lit(0).alias("part"), F.col("_sys._pos").alias("_pos"), F.col("_sys._seg").alias("_seg"), *none)
    # A window that starts within the allowance after a turn starts in the turn's block of tokens or in the next.
    block = lambda at: F.floor(F.col(at) / F.lit(max(history, 1)))
    back = placed.where(F.coalesce(F.col("_pos") != F.col("_sys._pos"), F.lit(True))).select(
        "_c", "_pos", "_seg", "_at", F.explode(F.array(block("_at"), block("_at") + 1)).alias("_block")
    )
    behind = F.col("_start") - F.col("_at")
    close = (behind > 0) & (behind <= history)
    repeats = back.join(starts.select("_c", "_span", "_start", block("_start").alias("_block")), ["_c", "_block"]).where(close)
    repeats = repeats.select("_c", "_span", F.lit(1).alias("part"), "_pos", "_seg", *none)
    parts = own.unionByName(repeats).unionByName(system)
    # A window is bounded by the budget, or by its one long turn.
    listed = F.sort_array(F.collect_list(F.struct("part", "_pos", "_seg", "head", "target")))
    made = parts.groupBy("_c", "_span").agg(listed.alias("_parts"))
    spans = (
        "aggregate(_parts, struct(0 AS at, CAST(array() AS array<struct<start:int,end:int>>) AS spans), "
        "(acc, p) -> struct(acc.at + length(p._seg) AS at, IF(p.target IS NULL, acc.spans, "
        "array_append(acc.spans, struct(acc.at + p.head AS start, acc.at + p.head + p.target AS end))) AS spans)).spans"
    )
    return made.select(
        F.when(F.col("_c") != _NO_CONV, F.col("_c")).alias("conv_id"),
        F.col("_span").alias("window"),
        F.array_join(F.transform("_parts", lambda p: p["_seg"]), "").alias("formatted"),
        F.size(F.filter("_parts", lambda p: p["part"] < 2)).alias("n_repeated"),
        F.expr(spans).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss, chars): own turns as role and text lines, and the text under the mask."""
    pieces = F.split("formatted", r"\Q" + f"{CLOSE}\n" + r"\E", -1)
    own = F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))
    turn = r"(?s)^\Q" + OPEN + r"\E((?:[^\\\n]++|\\.)*+)\n(.*)$"
    part = lambda x, i: unescaped(F.regexp_extract(x, turn, i))
    text = lambda x: F.struct(part(x, 1).alias("role"), part(x, 2).alias("text"))
    cut = lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))
    return formatted.select(
        "conv_id", "window",
        F.transform(own, text).alias("turns"),
        F.array_join(F.transform("loss_spans", cut), "").alias("loss"),
        F.length("formatted").cast("long").alias("chars"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each conversation. A digest of a whole conversation needs its text in one row."""
    back = read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = back.select("conv_id", F.size("turns").alias("n"), "chars", F.struct("window", said.alias("said"), "loss").alias("w"))
    joined = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("w")).alias("w"))
    text = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return joined.select("conv_id", "n_turns", text("said").alias("said"), text("loss").alias("loss"), "formatted_chars").select(
        "conv_id", "n_turns",
        F.sha2(F.encode("said", "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
