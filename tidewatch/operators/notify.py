"""From alerts to notifications: inhibition, routing, grouping, timing, texts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.functions.labels import labels_of
from tidewatch.functions.scan import DAY, HOUR, MICROS, MINUTE, Running, merged_intervals, overlapping, running, time_block
from tidewatch.functions.skew import salted_join
from tidewatch.operators.timeseries import rate


@dataclass(frozen=True)
class Route:
    receiver: str
    match: dict[str, str] = field(default_factory=dict)
    wait: int = 30  # seconds before the first notification
    interval: int = 300  # seconds before news of a known group
    repeat: int = 4 * 3600  # seconds before the same news is sent again


@dataclass(frozen=True)
class Inhibition:
    source: dict[str, str]
    equal: list[str]
    target: dict[str, str] = field(default_factory=dict)
    target_pattern: dict[str, str] = field(default_factory=dict)


# Routes in order, the default one last; group labels; inhibitions.
ROUTES = [
    Route("pagerduty-ai-platform", {"severity": "critical", "team": "ai-platform"}, wait=10, repeat=3600),
    Route("pagerduty-platform", {"severity": "critical", "team": "platform"}, wait=10, repeat=3600),
    Route("slack-ml-ops", {"team": "ml-ops"}, repeat=8 * 3600),
    Route("slack-data-eng", {"team": "data-engineering"}, repeat=4 * 3600),
    Route("slack-default", {"severity": "warning"}, repeat=8 * 3600),
    Route("slack-default"),
]
GROUP_BY = ["alertname", "pipeline", "service"]
INHIBITIONS = [
    Inhibition({"severity": "critical"}, ["alertname", "service", "pipeline"], target={"severity": "warning"}),
    Inhibition({"alertname": "ServiceDown"}, ["service"], target_pattern={"alertname": ".*ErrorRate|.*Latency"}),
]
# Receivers that are told of the end of an alert (all of them), and title prefixes.
SEND_RESOLVED = ["pagerduty-ai-platform", "pagerduty-platform", "slack-default", "slack-ml-ops", "slack-data-eng"]
TITLE_PREFIX = {"slack-default": "", "slack-ml-ops": "ML-OPS ", "slack-data-eng": "DATA-ENG "}


@dataclass(frozen=True)
class Page:
    severity: str | None = None  # None: the one that all alerts of the group share
    details: dict[str, str] = field(default_factory=dict)  # name on the page, column of the group


# What the pages of a receiver carry.
PAGES = {
    "pagerduty-ai-platform": Page(details={"pipeline": "pipeline", "description": "common_description", "runbook": "common_runbook_url"}),
    "pagerduty-platform": Page(severity="critical"),
}


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def route(alerts: DataFrame, routes: Sequence[Route] = tuple(ROUTES)) -> DataFrame:
    """First matching route: receiver and timings in seconds. The route list is
    compiled into one CASE expression; no join."""
    picked = None
    for r in routes:
        hit = _all([F.col(k) == v for k, v in r.match.items()])
        value = F.struct(
            F.lit(r.receiver).alias("receiver"),
            F.lit(r.wait).alias("group_wait"),
            F.lit(r.interval).alias("group_interval"),
            F.lit(r.repeat).alias("repeat_interval"),
        )
        picked = F.when(hit, value) if picked is None else picked.when(hit, value)
    return alerts.withColumn("_route", picked).select(*alerts.columns, "_route.*")


def _matches(labels: dict[str, str], patterns: dict[str, str] | None = None) -> Column:
    return _all([F.col(k) == v for k, v in labels.items()] + [F.col(k).rlike(f"^(?:{p})$") for k, p in (patterns or {}).items()])


def _mute_keys(rules: Sequence[Inhibition], side: str) -> Column:
    """Keys under which an alert mutes (``source``) or can be muted (``target``), over all rules at once.

    A key is the number of the rule, which of its sources count, and the values of the equal labels (absent
    equals absent). One that is on both sides of a rule meets the sources that are no targets themselves.
    """
    keys = []
    for i, rule in enumerate(rules):
        source, target = _matches(rule.source), _matches(rule.target, rule.target_pattern)
        values = F.array(*[F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")) for k in rule.equal])
        key = lambda when, kind: F.when(when, F.struct(F.lit(i).alias("rule"), F.lit(kind).alias("kind"), values.alias("labels")))  # noqa: B023, E731
        if side == "source":
            keys += [key(source, "all"), key(source & ~target, "pure")]
        else:
            keys += [key(target & ~source, "all"), key(target & source, "pure")]
    return F.array_compact(F.array(*keys))


def inhibit(alerts: DataFrame, rules: Sequence[Inhibition] = tuple(INHIBITIONS), block_us: int = DAY) -> DataFrame:
    """The times at which firing alerts are not muted by another firing alert.

    A target is muted while a source with equal labels (absent equals absent)
    fires. An alert comes back as one row per interval left of it, its begin and
    end in ``firing_us`` and ``resolved_us``; one that is muted throughout has
    none. Every firing alert is a source, muted or not; one that matches both
    sides of a rule mutes only alerts that match the target side alone. Rows
    that repeat come back as often as they went in.

    All rules go in one pass: alerts are tagged with the keys of the rules they
    meet, the sources of a key are merged to disjoint stretches, both sides are
    cut at block borders, which makes the interval join an equi-join, and the
    stretches of all rules are taken from the alert together. The number of
    scans does not depend on the number of rules.
    """
    if not rules:
        return alerts.where(F.col("firing_us").isNotNull())
    names = alerts.columns
    firing = alerts.where(F.col("firing_us").isNotNull())
    blocks = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / block_us), F.floor((F.col(b) - 1) / block_us)))
    sources = firing.where("firing_us < resolved_us").select(F.explode(_mute_keys(rules, "source")).alias("_mute"), "firing_us", "resolved_us")
    busy = merged_intervals(sources, ["_mute"], "firing_us", "resolved_us", block_us)
    busy = busy.select("_mute", F.col("firing_us").alias("_from"), F.col("resolved_us").alias("_to")).withColumn("_block", blocks("_from", "_to"))
    distinct = firing.groupBy(*[F.col(c) for c in names]).agg(F.count(F.lit(1)).alias("_copies"))
    tagged = distinct.withColumn("_keys", _mute_keys(rules, "target"))
    # What no rule has as a target, and what has no length, is left as it is.
    free = (F.size("_keys") == 0) | ~F.coalesce(F.col("firing_us") < F.col("resolved_us"), F.lit(False))
    targets = tagged.withColumn("_mute", F.explode_outer(F.when(~free, F.col("_keys")))).drop("_keys")
    placed = targets.withColumn("_block", F.explode(F.when(F.col("_mute").isNull(), F.array(F.lit(0).cast("long"))).otherwise(
        F.sequence(F.floor(F.col("firing_us") / block_us), F.floor((F.col("resolved_us") - 1) / block_us))
    )))
    meets = (F.col("_from") < F.col("resolved_us")) & (F.col("_to") > F.col("firing_us"))
    met = F.array_compact(F.sort_array(F.collect_set(F.when(meets, F.struct("_from", "_to")))))
    held = placed.join(busy, ["_mute", "_block"], "left").groupBy(*[F.col(c) for c in names], "_copies").agg(
        met.alias("_met"), F.max(F.col("_mute").isNull()).alias("_free")
    )
    # Stretches of different rules may overlap: a gap opens at the latest end so far.
    latest = lambda so_far, m: F.array_append(so_far, F.greatest(F.try_element_at(so_far, F.lit(-1)), m["_to"]))
    held = held.withColumn("_ends", F.aggregate("_met", F.array().cast("array<bigint>"), latest))
    gaps = F.arrays_zip(
        F.concat(F.array("firing_us"), F.col("_ends")).alias("a"),
        F.concat(F.transform("_met", lambda m: m["_from"]), F.array("resolved_us")).alias("b"),
    )
    rest = F.when(F.col("_free"), F.array(F.struct(F.col("firing_us").alias("a"), F.col("resolved_us").alias("b")))).otherwise(F.filter(gaps, lambda x: x["a"] < x["b"]))
    left = held.select(*names, "_copies", F.inline(rest)).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))))
    times = {"firing_us": "a", "resolved_us": "b"}
    return left.select(*[F.col(times.get(c, c)).alias(c) for c in names])


def with_life(routed: DataFrame, group_by: Sequence[str] = tuple(GROUP_BY), block_us: int = DAY) -> DataFrame:
    """Number the lives of every group. An alert opens a new life when all
    earlier alerts of its group have ended before it starts."""
    keys = ["receiver", *group_by]
    return overlapping(routed, keys, "firing_us", "resolved_us", ["alertname", "series"], block_us, "life")


def group_alerts(lived: DataFrame, group_by: Sequence[str] = tuple(GROUP_BY)) -> DataFrame:
    """One row per life of a group: counts, times and the values all its alerts
    share (NULL where they differ). Alerts are not gathered into a list."""

    def common(name: str) -> Column:
        same = (F.min(name) == F.max(name)) & (F.count(name) == F.count(F.lit(1)))
        return F.when(same, F.min(name)).alias(f"common_{name}")

    shared = [n for n in ("severity", "summary", "description", "runbook_url") if n in lived.columns]
    timings = ["group_wait", "group_interval", "repeat_interval"]
    return lived.groupBy("receiver", *group_by, "life").agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min("firing_us").alias("began_us"),
        F.max("resolved_us").alias("ended_us"),
        *[F.max(t).alias(t) for t in timings],
        *[common(n) for n in shared],
    )


def notifications(lived: DataFrame, group_by: Sequence[str] = tuple(GROUP_BY)) -> DataFrame:
    """Notification times of every group life.

    The first notification follows ``group_wait`` after the first alert. A later
    alert is news, sent at the next multiple of ``group_interval`` after the
    first notification. Without news the group repeats every ``repeat_interval``
    after the last one. Receivers that ask for it are told of the end.

    Alerts are combined per group and instant first; the windows see at most one
    row per instant of a life, and all of them share one partitioning.
    """
    keys = ["receiver", *group_by, "life"]
    timings = ["group_wait", "group_interval", "repeat_interval"]
    starts = lived.groupBy(*keys, "firing_us").agg(F.max("resolved_us").alias("ended_us"), *[F.max(t).alias(t) for t in timings])
    whole = Window.partitionBy(*keys)
    flush = F.col("group_interval").cast("long") * MICROS
    known = starts.withColumns(
        {
            "ended_us": F.max("ended_us").over(whole),
            "first_us": F.min("firing_us").over(whole) + F.max("group_wait").over(whole) * MICROS,
            "group_interval": F.max("group_interval").over(whole),
            "repeat_interval": F.max("repeat_interval").over(whole),
        }
    ).where(F.col("first_us") < F.col("ended_us"))
    late = F.greatest(F.col("firing_us") - F.col("first_us"), F.lit(0))
    news = (
        known.withColumn("sent_us", F.col("first_us") + F.ceil(late / flush) * flush)
        .where(F.col("sent_us") < F.col("ended_us"))
        .groupBy(*keys, "first_us", "ended_us", "group_interval", "repeat_interval", "sent_us")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # Repeats fill the time to the next news or to the end of the life.
    stop = F.coalesce(F.lead("sent_us").over(whole.orderBy("sent_us")), F.col("ended_us")) - 1
    again = F.sequence(F.col("sent_us"), F.col("_stop"), F.col("repeat_interval").cast("long") * MICROS)
    notice = lambda at, reason, status: F.struct(at.alias("sent_us"), reason.alias("reason"), F.lit(status).alias("status"))
    firing = F.transform(again, lambda at: notice(at, F.when(at == F.col("sent_us"), "news").otherwise("repeat"), "firing"))
    over = F.col("first_us") + F.ceil((F.col("ended_us") - F.col("first_us")) / flush) * flush
    closes = (F.col("sent_us") == F.col("first_us")) & F.col("receiver").isin(SEND_RESOLVED)
    ending = F.array_compact(F.array(F.when(closes, notice(over, F.lit("end"), "resolved"))))
    return news.withColumn("_stop", stop).select(*keys, F.inline(F.concat(firing, ending)))


def title(status: Column, summary: Column, receiver: Column) -> Column:
    """Chat title: prefix of the receiver and the status in capitals."""
    prefix = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in TITLE_PREFIX.items() for x in p]), receiver), F.lit(""))
    return F.concat(F.lit("["), prefix, F.upper(status), F.lit("] "), F.coalesce(summary, F.lit("")))


def render_alert(receiver: Column) -> Column:
    """Text block of one alert for a chat receiver (from summary, severity,
    pipeline, description, runbook_url). A missing label renders empty."""
    safe = lambda n: F.coalesce(F.col(n), F.lit(""))
    head = [F.lit("*Alert:* "), safe("summary"), F.lit("\n")]
    body = [F.lit("*Description:* "), safe("description"), F.lit("\n")]
    labels = [F.lit("*Severity:* `"), safe("severity"), F.lit("`\n*Pipeline:* `"), safe("pipeline"), F.lit("`\n")]
    runbook = F.when(F.col("runbook_url").isNotNull(), F.concat(F.lit("*Runbook:* "), F.col("runbook_url"), F.lit("\n"))).otherwise("")
    return F.when(receiver == "slack-default", F.concat(*head, *labels, *body, runbook)).otherwise(F.concat(*head, *body))


def chat_titles(groups: DataFrame, status: str = "firing") -> DataFrame:
    """Title and colour of a group message; the title names the summary only
    when all alerts of the group share it."""
    return groups.withColumns(
        {
            "title": title(F.lit(status), F.col("common_summary"), F.col("receiver")),
            "color": F.when(F.col("receiver") == "slack-default", "danger" if status == "firing" else "good"),
        }
    )


def page_payloads(
    notices: DataFrame, groups: DataFrame, group_by: Sequence[str] = tuple(GROUP_BY), pages: dict[str, Page] = PAGES
) -> DataFrame:
    """The page of every notice to a paging receiver.

    ``notices`` are those of ``notifications``, ``groups`` those of
    ``group_alerts``. A page has the action (trigger or resolve), the key under
    which the paging service keeps the group, a severity, a description and a
    map of details. The values are those that all alerts of the life share; one
    that differs or is missing is empty. Receivers without pages give no row.
    """
    keys = ["receiver", *group_by, "life"]
    paged = lambda df: df.where(F.col("receiver").isin(list(pages)))
    g, n = paged(groups).alias("g"), paged(notices).alias("n")
    # Group labels may be absent: absent equals absent.
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"g.{k}")) for k in keys]
    shared = [F.col(f"g.{c}") for c in groups.columns if c.startswith("common_")]
    met = n.join(g, _all(same)).select("n.*", *shared)
    safe = lambda name: F.coalesce(F.col(name), F.lit(""))
    by_receiver = lambda value: F.coalesce(*[F.when(F.col("receiver") == r, value(p)) for r, p in pages.items()])
    details = lambda p: F.create_map(*[x for name, c in p.details.items() for x in (F.lit(name), safe(c))]) if p.details else F.create_map().cast("map<string,string>")
    labels = F.concat_ws(",", "receiver", *[F.concat(F.lit(f"{k}="), F.col(k)) for k in group_by])
    return met.select(
        *keys,
        "sent_us",
        F.when(F.col("status") == "firing", "trigger").otherwise("resolve").alias("action"),
        F.sha2(labels, 256).alias("dedup_key"),
        by_receiver(lambda p: F.lit(p.severity) if p.severity is not None else safe("common_severity")).alias("severity"),
        safe("common_summary").alias("description"),
        by_receiver(details).alias("details"),
    )


def chat_blocks(lived: DataFrame, group_by: Sequence[str] = tuple(GROUP_BY), block_us: int = DAY) -> DataFrame:
    """One numbered text block per alert. A message is the blocks of its group in
    this order; whoever delivers it joins them, so that a large group is never
    gathered in one row."""
    order = ["firing_us", "alertname", "series"]
    numbered = running(
        lived,
        ["receiver", *group_by, "life"],
        order,
        time_block("firing_us", block_us),
        {"position": Running("sum", F.lit(1).cast("long"))},
    )
    return numbered.withColumn("text", render_alert(F.col("receiver")))


def incidents(alerts: DataFrame, gap_us: int = 30 * MINUTE, block_us: int = HOUR) -> DataFrame:
    """Alerts of all services whose starts are at most ``gap_us`` apart, with the
    alert that came first. Starts are combined per instant before the scan."""
    name = F.struct("alertname", "series")
    starts = alerts.where(F.col("firing_us").isNotNull()).groupBy("active_us").agg(
        F.min(name).alias("first"), F.count(F.lit(1)).alias("n")
    )
    numbered = running(
        starts, [], ["active_us"], time_block("active_us", block_us), {"_prev": Running("last", F.col("active_us"), inclusive=False)}
    )
    opens = F.when(F.col("active_us") - F.col("_prev") <= gap_us, 0).otherwise(1).cast("long")
    tagged = running(
        numbered.withColumn("_opens", opens), [], ["active_us"], time_block("active_us", block_us), {"incident": Running("sum", F.col("_opens"))}
    )
    return tagged.groupBy("incident").agg(
        F.min("active_us").alias("began_us"),
        F.max("active_us").alias("last_start_us"),
        F.min_by("first.alertname", "active_us").alias("first_alert"),
        F.min_by("first.series", "active_us").alias("first_series"),
        F.sum("n").alias("alerts"),
    )


# A value spikes when it lies so many robust deviations above the median of its series at that hour of the day.
SPIKE_SCORE = 3.5
# By these name endings a metric is a counter, and is judged by its rate.
COUNTER_ENDINGS = ("_total", "_bucket", "_count", "_sum", "_offset")
# A standard deviation in median deviations, and in mean deviations where that median is zero.
MEDIAN_SCALE, MEAN_SCALE = 1.4826, 1.2533


def spike_scores(samples: DataFrame, bucket_us: int = HOUR) -> DataFrame:
    """``metric, series, end_us, value, score``: robust score of every series and time bucket.

    A counter's value is its rate over the bucket, a gauge's its highest sample.
    The score is the distance from the median of the series at the same hour of
    the day, over the median deviation there. Where more than half of the values
    are equal the mean deviation stands in; a constant series has no score. A
    histogram counts by its last bucket, which holds all observations. A median
    sees one value a day and bucket of one series and hour.
    """
    counter = F.col("metric").rlike("(" + "|".join(COUNTER_ENDINGS) + ")$")
    plain = samples.where((F.col("le").isNull() | (F.col("le") == float("inf"))) & ~F.isnan("value"))
    rates = rate(plain.where(counter), ["metric", "series"], bucket_us, bucket_us).withColumnRenamed("eval_us", "end_us")
    end = (F.ceil(F.col("us") / bucket_us) * bucket_us).cast("long").alias("end_us")
    levels = plain.where(~counter).groupBy("metric", "series", end).agg(F.max("value").alias("value"))
    hour = Window.partitionBy("metric", "series", F.floor(F.pmod(F.col("end_us"), F.lit(DAY)) / HOUR))
    far = rates.unionByName(levels).withColumn("_median", F.median("value").over(hour)).withColumn("_far", F.abs(F.col("value") - F.col("_median")))
    spread = far.withColumns({"_middle": F.median("_far").over(hour), "_mean": F.avg("_far").over(hour)})
    # Deviations this small against the median are rounding.
    real = lambda c: F.col(c) > F.abs(F.col("_median")) * 1e-9
    scale = F.when(real("_middle"), F.col("_middle") * MEDIAN_SCALE).when(real("_mean"), F.col("_mean") * MEAN_SCALE)
    return spread.select("metric", "series", "end_us", "value", ((F.col("value") - F.col("_median")) / scale).alias("score"))


def spiking_metrics(
    alerts: DataFrame, samples: DataFrame, before_us: int = 15 * MINUTE, bucket_us: int = HOUR, min_score: float = SPIKE_SCORE
) -> DataFrame:
    """The metrics that spike near each firing alert, with the strongest score and its value.

    A series counts when none of its labels contradicts the alert's: a label of
    both has the same value. Only spikes go into the join, which is by bucket
    and service (one that is absent meets every service); a bucket with very
    many alerts is salted.
    """
    # Scores that differ in rounding alone are equal; of equal scores the higher value counts.
    spikes = spike_scores(samples, bucket_us).withColumn("score", F.round("score", 6)).where(F.col("score") >= min_score)
    any_service, none = F.lit("any"), F.lit("none")
    is_ = lambda service: F.concat(F.lit("="), service)
    own = F.try_element_at(labels_of("series"), F.lit("service"))
    keyed = spikes.select(
        "metric", F.col("series").alias("_series"), F.col("end_us").alias("bucket"), "value", "score",
        F.explode(F.array(F.coalesce(is_(own), none), any_service)).alias("_service"),
    )
    round_up = lambda us: (F.ceil(us / bucket_us) * bucket_us).cast("long")
    service = F.try_element_at(labels_of("series"), F.lit("service"))
    spans = alerts.where(F.col("firing_us").isNotNull()).select(
        "alertname", "series", "active_us", "resolved_us",
        F.explode(F.when(service.isNull(), F.array(any_service)).otherwise(F.array(is_(service), none))).alias("_service"),
    ).withColumn(
        "bucket", F.explode(F.sequence(round_up(F.col("active_us") - before_us), round_up(F.col("resolved_us")), F.lit(bucket_us).cast("long")))
    ).drop("resolved_us")
    met = salted_join(spans, keyed, ["bucket", "_service"], ["alertname", "series", "active_us"], "inner")
    theirs = labels_of("_series")
    agree = F.forall(F.map_entries(labels_of("series")), lambda e: F.coalesce(F.try_element_at(theirs, e["key"]) == e["value"], F.lit(True)))
    return met.where(agree).groupBy("alertname", "series", "active_us", "metric").agg(
        F.max("score").alias("score"), F.max_by("value", F.struct("score", "value")).alias("peak")
    )
