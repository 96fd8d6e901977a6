"""Alert rules over samples: evaluation, the ``for`` clause, alert rows.

``samples`` has ``metric, series, le, us, value`` where ``series`` is the
canonical text of the labels. Rules are configuration: a short list, joined as
a broadcast table whose size is checked. Conditions are evaluated on a grid,
only true evaluations are kept, and runs of consecutive true evaluations become
alerts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.formatting import humanize, humanize_duration, humanize_percentage, plain
from tidewatch.functions.labels import labels_of, series_key, without
from tidewatch.functions.scan import DAY, MICROS, islands
from tidewatch.operators import timeseries as ts
from tidewatch.operators.relabel import EXTERNAL_LABELS, keep_missing, label_map, upsert
from tidewatch.plans.alert_rules import AVERAGE_KEEPS, RATIO_DROPS, RULES, Rule

# A longer list is joined by a shuffle.
BROADCAST_RULES = 10_000
RANGE_SHAPES = ("ratio_of_rates", "quantile", "rate", "average_rate")


def bounded(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Hint the broadcast of a rule table that is short enough."""
    return F.broadcast(table) if len(rules) <= BROADCAST_RULES else table


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules as rows."""
    rows = [
        (r.name, r.metric, r.where, r.part, r.window * MICROS, r.every * MICROS, r.q, r.scale, r.offset, r.op, r.threshold)
        for r in rules
    ]
    return spark.createDataFrame(
        [tuple(float(x) if i in (6, 7, 8, 10) else x for i, x in enumerate(row)) for row in rows],
        "alertname STRING, metric STRING, matchers MAP<STRING,STRING>, part MAP<STRING,STRING>, window_us BIGINT, every_us BIGINT, "
        "q DOUBLE, scale DOUBLE, shift DOUBLE, op STRING, threshold DOUBLE",
    )


def matches(labels: Column, wanted: Column) -> Column:
    """All entries of ``wanted`` are labels with the same value."""
    return F.forall(F.map_entries(wanted), lambda e: F.coalesce(F.try_element_at(labels, e["key"]) == e["value"], F.lit(False)))


def compare(value: Column, op: Column, threshold: Column) -> Column:
    return F.when(op == ">", value > threshold).when(op == "<", value < threshold).otherwise(value == threshold)


def _selected(samples: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Samples of the rules' metrics, once per rule that reads them."""
    table = rule_table(samples.sparkSession, rules)
    read = samples.where(F.col("metric").isin(sorted({r.metric for r in rules})))
    joined = read.join(bounded(table, rules), "metric").withColumn("_labels", labels_of("series"))
    wanted = F.col("matchers")
    return joined.where(((F.size(wanted) == 0) | matches(F.col("_labels"), wanted)) & ~F.isnan("value"))


RULE_COLUMNS = ["every_us", "scale", "shift", "op", "threshold"]


def _rates(samples: DataFrame, rules: Sequence[Rule], keys: Sequence[str], carry: Sequence[str], extrapolate: bool) -> DataFrame:
    vector = ts.range_vector(
        samples, ["alertname", *keys], F.col("window_us"), F.col("every_us"), [*RULE_COLUMNS, "window_us", *carry]
    ).where(F.col("samples") >= 2)
    value = ts.extrapolated(F.col("window_us")) if extrapolate else F.col("increase")
    return vector.withColumn("value", value / (F.col("window_us") / 1e6))


def _shape(samples: DataFrame, shape: str, rules: Sequence[Rule], lookback_us: int, extrapolate: bool) -> DataFrame:
    """Value of all rules of one shape: ``alertname, series, eval_us, value``."""
    chosen = _selected(samples, rules)
    out = ["alertname", "series", "eval_us", "value", *RULE_COLUMNS]
    group = ["alertname", "series", "eval_us", *RULE_COLUMNS]
    if shape == "rate":
        return _rates(chosen, rules, ["series"], [], extrapolate).select(*out)
    if shape == "ratio_of_rates":
        rest = series_key(without(F.col("_labels"), *RATIO_DROPS))
        tagged = chosen.withColumns({"_rest": rest, "_in": matches(F.col("_labels"), F.col("part"))})
        rates = _rates(tagged, rules, ["series"], ["_rest", "_in"], extrapolate).drop("series").withColumnRenamed("_rest", "series")
        return ts.ratio_of(rates, F.col("_in"), [c for c in group if c != "eval_us"]).select(*out)
    if shape == "quantile":
        rates = _rates(chosen, rules, ["series", "le"], ["q"], extrapolate)
        return ts.histogram_quantile(F.col("q"), rates, ["alertname", "series", "eval_us"], RULE_COLUMNS).select(*out)
    if shape == "average_rate":
        kept = F.map_filter(F.col("_labels"), lambda k, _: k.isin(*AVERAGE_KEEPS))
        rates = _rates(chosen.withColumn("_rest", series_key(kept)), rules, ["series"], ["_rest"], extrapolate)
        return rates.drop("series").withColumnRenamed("_rest", "series").groupBy(*group).agg(F.avg("value").alias("value")).select(*out)
    keys = ["alertname", "series", *RULE_COLUMNS]
    points = ts.instant_vector(chosen, keys, F.col("every_us"), lookback_us)
    if shape == "gauge":
        return points.select(*out)
    if shape == "age":
        return ts.age(points).select(*out)
    if shape == "gauge_ratio":
        below = [Rule(**{**r.__dict__, "metric": r.over}) for r in rules]
        bottom = ts.instant_vector(_selected(samples, below), keys, F.col("every_us"), lookback_us)
        return ts.combine(points, bottom, keys, F.col("l") / F.nullif(F.col("r"), F.lit(0.0))).select(*out)
    raise ValueError(f"unknown shape {shape}")


def evaluate_rules(
    samples: DataFrame, rules: Sequence[Rule] = tuple(RULES), lookback_us: int = ts.LOOKBACK_US, extrapolate: bool = False
) -> DataFrame:
    """True evaluations: ``alertname, series, eval_us, every_us, value``.

    Rules run in one pass per shape; each pass reads the metrics of its rules.
    """
    shapes: dict[str, list[Rule]] = {}
    for rule in rules:
        shapes.setdefault(rule.shape, []).append(rule)
    parts = []
    for shape, members in shapes.items():
        raw = _shape(samples, shape, members, lookback_us, extrapolate)
        value = F.when(F.col("scale") == 1.0, F.col("value")).otherwise(F.col("value") * F.col("scale")) + F.col("shift")
        scaled = raw.withColumn("value", value)
        hit = compare(F.col("value"), F.col("op"), F.col("threshold")) & ~F.isnan("value")
        parts.append(scaled.where(hit).select("alertname", "series", "eval_us", "every_us", "value"))
    return reduce(DataFrame.unionByName, parts)


PARTS = "ARRAY<STRUCT<kind: STRING, text: STRING>>"


def template_parts(template: str) -> list[tuple[str, str]]:
    """A rule text cut into literals, labels (``$name``) and values
    (``$value`` or ``$value|format``)."""
    parts: list[tuple[str, str]] = []
    position = 0
    for found in re.finditer(r"\$(\w+)(?:\|(\w+))?", template):
        if found.start() > position:
            parts.append(("literal", template[position : found.start()]))
        name, kind = found.groups()
        parts.append(("value", kind or "plain") if name == "value" else ("label", name))
        position = found.end()
    if position < len(template):
        parts.append(("literal", template[position:]))
    return parts


def fill(parts: Column, labels: Column, formatted: Column) -> Column:
    """Text from its parts; an absent label is empty."""
    return F.array_join(
        F.transform(
            parts,
            lambda p: F.when(p["kind"] == "literal", p["text"])
            .when(p["kind"] == "label", F.coalesce(F.try_element_at(labels, p["text"]), F.lit("")))
            .otherwise(F.try_element_at(formatted, p["text"])),
        ),
        "",
    )


def alert_rows(
    evaluations: DataFrame,
    rules: Sequence[Rule] = tuple(RULES),
    runbook_root: str | None = None,
    block_us: int = DAY,
) -> DataFrame:
    """Alerts from true evaluations.

    A run of evaluations without a gap is pending from its start and fires when
    it has lasted ``hold``; a gap starts anew. ``resolved_us`` is the first
    evaluation that is not true. Runs that never last long enough stay
    ``pending`` with a NULL ``firing_us``.
    """
    spark = evaluations.sparkSession
    runs = islands(evaluations, ["alertname", "series"], "eval_us", F.col("every_us"), block_us, ["value", "every_us"])
    root = runbook_root.rstrip("/") if runbook_root else None
    hold = spark.createDataFrame(
        [
            (
                r.name, r.hold * MICROS, r.severity, r.team, r.pipeline or None, template_parts(r.summary),
                template_parts(r.description), f"{root}/{r.runbook}" if root and r.runbook else None,
            )
            for r in rules
        ],
        "alertname STRING, hold_us BIGINT, severity STRING, team STRING, pipeline STRING, "
        f"summary {PARTS}, description {PARTS}, runbook_url STRING",
    )
    every = F.col("last_every_us")
    fires = F.col("start_us") + F.ceil(F.col("hold_us") / every) * every
    own = F.create_map(
        F.lit("alertname"), F.col("alertname"), F.lit("severity"), F.col("severity"),
        F.lit("team"), F.col("team"), F.lit("pipeline"), F.col("pipeline"),
    )
    value = F.col("last_value")
    formatted = F.create_map(
        F.lit("plain"), plain(value), F.lit("humanize"), humanize(value),
        F.lit("percentage"), humanize_percentage(value), F.lit("duration"), humanize_duration(value),
    )
    fired = F.col("firing_us").isNotNull()
    labelled = (
        runs.join(bounded(hold, rules), "alertname")
        .withColumns({"_series": F.coalesce(labels_of("series"), label_map({})), "_values": formatted})
        .withColumn("labels", upsert(F.col("_series"), F.map_filter(own, lambda _, v: v.isNotNull())))
        .withColumn("firing_us", F.when(fires <= F.col("end_us"), fires))
    )
    return labelled.select(
        "alertname",
        "series",
        "labels",
        "severity",
        "team",
        F.try_element_at("labels", F.lit("pipeline")).alias("pipeline"),
        F.try_element_at("_series", F.lit("service")).alias("service"),
        F.col("start_us").alias("active_us"),
        "firing_us",
        (F.col("end_us") + every).alias("resolved_us"),
        value.alias("value"),
        F.when(fired, "firing").otherwise("pending").alias("state"),
        fill(F.col("summary"), F.col("labels"), F.col("_values")).alias("summary"),
        fill(F.col("description"), F.col("labels"), F.col("_values")).alias("description"),
        "runbook_url",
    )


def outgoing(alerts: DataFrame, external: dict[str, str] = EXTERNAL_LABELS) -> DataFrame:
    """Firing alerts with the external labels added."""
    return alerts.where(F.col("state") == "firing").withColumn("labels", keep_missing(F.col("labels"), external))
