"""Agent trajectories: sessions, ordered traces, tool outcomes, loops, context."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.scan import Running, running
from tidewatch.operators.metrics import word_count

# Registered tools with their argument, and preview lengths.
TOOLS = {"web_search": "query", "calculator": "expression", "get_current_metrics": "service"}
TASK_PREVIEW = 100
REASONING_PREVIEW = 200
RESULT_PREVIEW = 300
MAX_STEPS = 10


def session_summary(
    steps: DataFrame, max_steps: int = MAX_STEPS, failed: Column | None = None, final: Column | None = None
) -> DataFrame:
    """Steps to sessions: recorded steps, duration, status.

    A session is ``failed`` when the aggregate ``failed`` holds, else
    ``max_steps_reached`` when it used all its steps (and, if ``final`` is
    given, has no final answer), else ``completed``.
    """
    n = F.count(F.lit(1))
    stuck = n >= max_steps
    if final is not None:
        stuck = stuck & ~F.coalesce(F.max(final), F.lit(False))
    broken = F.lit(False) if failed is None else failed
    return steps.groupBy("session_id").agg(
        F.max("agent_name").alias("agent_name"),
        n.cast("int").alias("steps_taken"),
        F.min("us").alias("start_us"),
        F.max("us").alias("end_us"),
        ((F.max("us") - F.min("us")).cast("double") / 1000).alias("duration_ms"),
        F.when(broken, "failed").when(stuck, "max_steps_reached").otherwise("completed").alias("status"),
    )


def step_trace(steps: DataFrame, columns: Sequence[str] = ("step", "tool_name"), max_steps: int = 1000) -> DataFrame:
    """Nested, ordered step lists.

    A list holds at most ``max_steps`` steps; longer sessions continue in
    further rows (``part`` 0, 1, ...), so nothing is dropped and no list grows
    without bound. ``columns`` starts with the step number, counted from 1.
    """
    part = F.floor((F.col(columns[0]) - 1) / max_steps).cast("long")
    return (
        steps.groupBy("session_id", part.alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("step_trace"))
    )


def tool_outcomes(
    calls: DataFrame,
    name: str = "tool_name",
    success: str = "tool_success",
    tools: Sequence[str] = tuple(TOOLS),
) -> DataFrame:
    """``success`` / ``error`` for registered tools, ``not_found`` for others."""
    known = F.col(name).isin(*tools)
    status = F.when(~known, "not_found").when(F.col(success), "success").otherwise("error")
    return calls.where(F.col(name).isNotNull()).withColumn("tool_status", status)


def parse_arguments(calls: DataFrame, text: str = "tool_args") -> DataFrame:
    """``tool_input`` map (empty when the text is not a JSON object) and the
    first argument value (empty text when there is none)."""
    parsed = F.coalesce(F.from_json(text, T.MapType(T.StringType(), T.StringType())), F.create_map().cast("map<string,string>"))
    return calls.withColumn("tool_input", parsed).withColumn(
        "first_argument", F.coalesce(F.try_element_at(F.map_values("tool_input"), F.lit(1)), F.lit(""))
    )


def preview(text: Column | str, length: int) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.substring(c, 1, length)


def repeated_calls(calls: DataFrame, arguments: str = "first_argument") -> DataFrame:
    """Same tool with the same arguments more than once in a session."""
    return (
        calls.groupBy("session_id", "tool_name", arguments)
        .agg(F.count(F.lit(1)).alias("calls"), F.min("step").alias("first_step"), F.max("step").alias("last_step"))
        .where(F.col("calls") > 1)
    )


def consecutive_repeats(calls: DataFrame, block: Column, arguments: str = "first_argument") -> DataFrame:
    """Calls equal to the call right before them in the session."""
    this = F.struct("tool_name", arguments)
    before = {"_before": Running("last", this, inclusive=False)}
    return running(calls, ["session_id"], ["step"], block, before).where(F.col("_before") == this).drop("_before")


def context_growth(turns: DataFrame, key: str = "conv_id", order: str = "turn", text: str = "text", block_turns: int = 1000) -> DataFrame:
    """Words of every turn and of the history up to it."""
    counted = turns.withColumn("tokens", word_count(text).cast("long"))
    block = F.floor(F.col(order) / block_turns).cast("long")
    return running(counted, [key], [order], block, {"context_tokens": Running("sum", F.col("tokens"))})
