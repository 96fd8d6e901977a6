"""Cheapest repair of conversation structure, by integer weights that carry the audit with the cost.

A repair is a path through a graph of (rows read, state): Keep, Rerole and Delete read a row,
Insert reads none, and the states follow the pattern of role initials ``(s?(ua)+)?``. The weight of
a path is one integer. Its high digits are the cost; its low digits, as many for every path of a
conversation, hold one digit per edit letter from the left, and zeros after the last one. The order
of these integers is cost first, then the audit in ASCII order with the end before any letter, so
an ordinary integer minimum at every node decides cost and ties alike. Nodes are worked from the
last row back: putting an edit in front moves all letters one digit to the right, which keeps the
order of two suffixes, also of suffixes that end early.

At most two inserts stand in a row between two rows: three lead back to a state that one had.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ready, row_key

LETTERS = "DIKR"  # digits 1 to 4, in ASCII order; 0 is the end
DIGIT = 3  # bits
RE_ROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
USER, ASSISTANT = "user", "assistant"
# States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, ASKED, ANSWERED = range(4)
# The state and role that an inserted or re-roled row leads to.
NEXT = {START: (ASKED, USER), SYSTEM: (ASKED, USER), ASKED: (ANSWERED, ASSISTANT), ANSWERED: (ASKED, USER)}
KEEPS = {(START, "s"): SYSTEM, (START, "u"): ASKED, (SYSTEM, "u"): ASKED, (ASKED, "a"): ANSWERED, (ANSWERED, "u"): ASKED}
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, CUT_OFF, SOUND = "blank", "duplicate", "truncated", ""


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): the rows after a damage that their place decides.

    A dropped row keeps its conv_id alone, so that conversations without rows are known.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn"))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("_kind"),
    )
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    gone = F.col("_kind") == 0
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    rows = rows.withColumn("_copy", copies)
    return rows.select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(~gone, F.when(F.col("_kind") == 4, USER).otherwise(F.col("role"))).alias("role"),
        F.when(~gone, text).alias("text"), gone.alias("dropped"),
    )


def faults(rows: list[tuple[str, str]]) -> list[str]:
    """The first fault of each row, or none."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(WHITE)
        fault = BLANK if not body else DUPLICATE if (role, text) in seen else CUT_OFF if body[-1] not in ".!?" else SOUND
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(initials: list[str], found: list[str]) -> tuple[int, str]:
    """(cost, audit) of the least path."""
    n = len(initials)
    width = DIGIT * (3 * n + 3)  # a letter per row, two inserts before each and at the end, one spare
    below = (1 << width) - 1
    first = width - DIGIT

    def moved(weight):
        """Room for a letter in front: letters one digit to the right."""
        low = weight & below
        return weight - low + (low >> DIGIT)

    def edit(letter: str, cost: int) -> int:
        return (cost << width) + (LETTERS.index(letter) + 1 << first)

    insert = edit("I", INSERT)

    def with_inserts(read):
        """Least weight of each state when up to two inserts come before what ``read`` holds."""
        best = []
        for state in range(4):
            one = NEXT[state][0]
            two = NEXT[one][0]
            ways = [read[state], None, None]
            if read[one] is not None:
                ways[1] = insert + moved(read[one])
            if read[two] is not None:
                ways[2] = insert + moved(insert + moved(read[two]))
            best.append(min(w for w in ways if w is not None))
        return best

    after = with_inserts([0, None, None, 0])
    delete = edit("D", DELETE)
    for i in range(n - 1, -1, -1):
        late = [moved(w) for w in after]
        read = [delete + w for w in late]
        if found[i] in (CUT_OFF, SOUND):
            more = TRUNCATED if found[i] == CUT_OFF else 0
            keep, rerole = edit("K", more), edit("R", RE_ROLE + more)
            for state in range(4):
                ways = [read[state], rerole + late[NEXT[state][0]]]
                to = KEEPS.get((state, initials[i]))
                if to is not None:
                    ways.append(keep + late[to])
                read[state] = min(ways)
        after = with_inserts(read)
    weight, letters = after[START], []
    digits = weight & below
    for at in range(first, -1, -DIGIT):
        digit = digits >> at & 7
        if not digit:
            break
        letters.append(LETTERS[digit - 1])
    return weight >> width, "".join(letters)


def repaired(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The rows after the edits of ``audit``, which fix the roles by the state they are in."""
    out, state, at = [], START, 0
    for letter in audit:
        if letter == "I":
            state, role = NEXT[state]
            out.append((role, ""))
            continue
        role, text = rows[at]
        at += 1
        if letter == "K":
            state = KEEPS[state, role[:1]]
            out.append((role, text))
        elif letter == "R":
            state, role = NEXT[state]
            out.append((role, text))
    return out


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_OUT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTS], ("audit", pa.string()), ("repaired", pa.list_(_TURN))])
REPAIRED = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired array<struct<role: string, text: string>>"
OUT_ROWS = 256


def _judged(conv_id, turns: list, rows: list[tuple[str, str]]) -> dict:
    initials = [role[:1] for role, _ in rows]
    found = faults(rows)
    cost, audit = cheapest(initials, found)
    known = {t for t in turns if t is not None}
    return {
        "conv_id": conv_id,
        "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
        **{f: found.count(f) for f in (BLANK, DUPLICATE, CUT_OFF)},
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired": [{"role": role, "text": text} for role, text in repaired(rows, audit)],
    }


def repair(damaged: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, the cheapest cost, its audit and the repaired turns.

    Rows are ordered by turn (nulls first), then role and text. Null roles and texts are one space.
    Rows without conv_id are one conversation; one whose rows are all ``dropped`` (a column that may
    be absent) has zeros, an empty audit and no turns. Other columns are not read; an empty table
    gives no rows. Conversations come one after another in sorted partitions; a task holds one at a
    time, as its repair depends on all its rows. Time grows with the square of its turns, at a
    word of 64 bits a step.
    """
    ready(damaged.sparkSession)
    gone = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in damaged.columns else F.lit(False)
    rows = damaged.select(
        row_key("conv_id").alias("_c"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), gone.alias("_gone"),
    )
    ordered = rows.repartition("_c").sortWithinPartitions("_c", F.col("turn").asc_nulls_first(), "role", "text")

    def worked(batches):
        key, conv_id, turns, held, out = None, None, [], [], []
        for batch in batches:
            for k, c, turn, role, text, dropped in zip(*(col.to_pylist() for col in batch.columns)):
                if k != key:
                    if key is not None:
                        out.append(_judged(conv_id, turns, held))
                    if len(out) >= OUT_ROWS:
                        yield pa.RecordBatch.from_pylist(out, schema=_OUT)
                        out = []
                    key, conv_id, turns, held = k, c, [], []
                if not dropped:
                    turns.append(turn)
                    held.append((role, text))
        if key is not None:
            out.append(_judged(conv_id, turns, held))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_OUT)

    return ordered.mapInArrow(worked, REPAIRED)


def digests(repaired_rows: DataFrame) -> DataFrame:
    """The repaired turns as the digest of their ``role:text`` lines."""
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    text = F.encode(F.array_join(lines, "\n"), "UTF-8")
    return repaired_rows.select("conv_id", *COUNTS, "audit", F.sha2(text, 256).alias("repaired_sha256"))
