"""Log-stream enrichment: classification, anomaly tags, routing, IP regions.

``enrich`` is one projection and is used unchanged on batch and streaming data.
Columns the input lacks count as absent values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.skew import salted_join
from tidewatch.functions.timeparse import parse_event_time

# Service names, tags, thresholds and labels of the classification.
SERVICE_TAGS = [
    ("genai-pipeline", "genai", ["genai", "llm"]),
    ("agentic-pipeline", "agentic", ["agentic", "llm"]),
    ("ml-pipeline", "ml", ["ml", "inference"]),
]
SLOW_CALL_MS = 5000
MAX_AGENT_STEPS = 20
MIN_CONFIDENCE = 0.6
DEFAULT_ENVIRONMENT = "production"
DEFAULT_CLUSTER = "ai-pipelines"
LOG_INDEX = "pipeline-logs-"
ERROR_INDEX = "pipeline-errors-"


def optional(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def first_of(df: DataFrame, kind: str, *names: str) -> Column:
    """First present value; different writers name the same field differently."""
    return F.coalesce(*[optional(df, n, kind) for n in names])


def enrich(df: DataFrame, environment: str = DEFAULT_ENVIRONMENT, cluster: str = DEFAULT_CLUSTER) -> DataFrame:
    """Add event_time, environment, cluster, tags, llm_model, anomaly, is_error."""
    service, kind = optional(df, "service", "string"), optional(df, "pipeline_type", "string")

    def belongs(index: int) -> Column:
        name, short, _ = SERVICE_TAGS[index]
        return F.coalesce(service == name, F.lit(False)) | F.coalesce(kind == short, F.lit(False))

    genai, agentic, ml = belongs(0), belongs(1), belongs(2)
    duration = first_of(df, "double", "duration_ms", "latency_ms")
    steps = first_of(df, "int", "agent_steps", "steps_taken")
    confidence = first_of(df, "double", "prediction_confidence", "confidence")
    yes = lambda c: F.coalesce(c, F.lit(False))
    slow = genai & yes(duration > SLOW_CALL_MS)
    limited = genai & (
        yes(optional(df, "error_type", "string") == "rate_limit_error") | yes(optional(df, "event", "string") == "llm_rate_limited")
    )
    looping = agentic & yes(steps > MAX_AGENT_STEPS)
    unsure = ml & yes(confidence < MIN_CONFIDENCE)
    level = F.upper(optional(df, "level", "string"))

    tag_sets = [
        *[F.when(belongs(i), F.array(*[F.lit(t) for t in tags])) for i, (_, _, tags) in enumerate(SERVICE_TAGS)],
        F.when(slow, F.array(F.lit("slow_llm_call"))),
        F.when(limited, F.array(F.lit("rate_limited"))),
        F.when(looping, F.array(F.lit("agent_loop_suspected"))),
        F.when(unsure, F.array(F.lit("low_confidence"))),
    ]
    none = F.array().cast("array<string>")
    started = F.coalesce(optional(df, "tags", "array<string>"), none)
    tags = started
    for found in tag_sets:
        tags = F.array_union(tags, F.coalesce(found, none))
    stamp = optional(df, "timestamp", "string")
    return df.withColumns(
        {
            "event_time": parse_event_time(stamp),
            "level": level,
            "environment": F.coalesce(optional(df, "environment", "string"), F.lit(environment)),
            "cluster": F.coalesce(optional(df, "cluster", "string"), F.lit(cluster)),
            "tags": tags,
            "llm_model": F.when(genai, optional(df, "model", "string")),
            "anomaly": F.when(slow, "high_latency").when(looping, "too_many_steps").when(unsure, "low_model_confidence"),
            "is_error": yes(level.isin("ERROR", "CRITICAL")),
        }
    )


def route_to_indices(enriched: DataFrame, time: str = "event_time") -> DataFrame:
    """One row per target index: the daily log index, and the daily error index
    for errors. Rows without a readable time go to the rejects (see streaming)."""
    day = F.date_format(time, "yyyy.MM.dd")
    targets = F.array(
        F.concat(F.lit(LOG_INDEX), day), F.when(F.col("is_error"), F.concat(F.lit(ERROR_INDEX), day))
    )
    return enriched.withColumn("index", F.explode(F.array_compact(targets)))


def ip_number(text: Column | str) -> Column:
    """Dotted IPv4 text to a number, NULL when malformed."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(c, r"\."), lambda p: p.try_cast("long"))
    good = (F.size(parts) == 4) & F.forall(parts, lambda p: F.coalesce(p.between(0, 255), F.lit(False)))
    return F.when(good, F.aggregate(parts, F.lit(0).cast("long"), lambda total, p: total * 256 + p))


def locate_ips(
    df: DataFrame, ranges: DataFrame, ip: str = "client_ip", spread: tuple[str, ...] = ("event_id",), target: str = "geoip"
) -> DataFrame:
    """Attach the region struct of the range that holds the address.

    ``ranges`` has ``start_ip, end_ip`` (numbers, disjoint) and attribute
    columns. Ranges are cut at /16 borders, which turns the range join into an
    equi-join with a residual; a hot /16 is salted. Neither side is broadcast,
    the range table may be as large as it likes.
    """
    prefix = 65536
    attributes = [c for c in ranges.columns if c not in ("start_ip", "end_ip")]
    facts = df.withColumn("_ip", ip_number(ip)).withColumn("_prefix", F.coalesce(F.floor(F.col("_ip") / prefix), F.lit(-1)).cast("long"))
    cut = ranges.withColumn(
        "_prefix",
        F.explode(F.sequence(F.floor(F.col("start_ip") / prefix).cast("long"), F.floor(F.col("end_ip") / prefix).cast("long"))),
    ).select("_prefix", "start_ip", "end_ip", F.struct(*attributes).alias(target))
    inside = F.col("f._ip").between(F.col("d.start_ip"), F.col("d.end_ip"))
    return salted_join(facts, cut, ["_prefix"], list(spread), "left", inside).drop("_ip", "_prefix", "start_ip", "end_ip")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def address_key(text: Column | str) -> Column:
    """IPv4 or IPv6 text as 32 hex digits, NULL when malformed; a v4 address is its mapped v6 address."""
    c = F.lower(F.col(text) if isinstance(text, str) else text)
    dotted = r"[0-9.]+\.[0-9.]+$"
    # A dotted tail counts as the last two groups.
    pair = lambda n: F.concat(F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(65535))))
    tail = _let(ip_number(F.regexp_extract(c, f"({dotted})", 1)), pair)
    plain = F.when(c.rlike(f":{dotted}"), F.concat(F.regexp_replace(c, dotted, ""), tail)).otherwise(c)
    groups = lambda half: F.when(half == "", F.array().cast("array<string>")).otherwise(F.split(half, ":", -1))

    def fill(sides: Column) -> Column:
        """All eight groups: zeros stand for at least one group where the text has a double colon, else for none."""
        missing = 8 - F.aggregate(sides, F.lit(0), lambda n, side: n + F.size(side))
        fits = ((F.size(sides) == 2) & (missing >= 1)) | ((F.size(sides) == 1) & (missing == 0))
        zeros = F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0)))
        return F.when(fits, F.concat(F.get(sides, F.lit(0)), zeros, F.coalesce(F.get(sides, F.lit(1)), F.array().cast("array<string>"))))

    joined = lambda whole: F.when(
        F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$")), F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), "")
    )
    v6 = _let(_let(F.transform(F.split(plain, "::", -1), groups), fill), joined)
    v4 = F.concat(F.lit("0" * 20 + "ffff"), F.lpad(F.lower(F.hex(ip_number(c))), 8, "0"))
    return F.when(c.contains(":"), v6).otherwise(v4)


def key_prefix(key: Column, length: Column) -> Column:
    """The first ``length`` bits of an address key as hex digits, the last digit's other bits cleared."""
    whole, rest = F.floor(length / 4).cast("int"), length % 4
    nibble = F.substring(key, whole + 1, F.lit(1))
    cleared = F.lit("")
    for r in (1, 2, 3):
        masked = "".join(f"{d & (16 - (16 >> r)):x}" for d in range(16))
        cleared = F.when(rest == r, F.translate(nibble, "0123456789abcdef", masked)).otherwise(cleared)
    return F.concat(F.substring(key, F.lit(1), whole), cleared)


def locate_networks(
    df: DataFrame, networks: DataFrame, ip: str = "client_ip", network: str = "network", spread: tuple[str, ...] = ("event_id",), target: str = "geoip"
) -> DataFrame:
    """Attach the attributes of the longest network that holds the address, v4 or v6.

    ``networks`` has networks as text (``10.0.0.0/8``, ``2001:db8::/32``, or one
    address) and attribute columns; they may nest. Bits behind the prefix are
    ignored, malformed networks and addresses match nothing, and of a network
    given twice the smallest attributes count. A v4 network is one of the mapped
    v6 addresses, so that ``::ffff:10.0.0.1`` lies in ``10.0.0.0/8``.

    Distinct texts are parsed and meet the networks by equality on each prefix
    length that occurs (at most 129); the rows are then joined by text, hot ones salted.
    Nothing is broadcast but the list of lengths.
    """
    attributes = [c for c in networks.columns if c != network]
    parts = F.split(network, "/", -1)
    first, size = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    longest = F.when(first.contains(":"), 128).otherwise(32)
    bits = F.when(F.size(parts) == 1, longest).when((F.size(parts) == 2) & size.rlike("^[0-9]{1,3}$"), size.try_cast("int"))
    keyed = networks.select(
        address_key(first).alias("_key"), F.when(bits <= longest, bits + 128 - longest).alias("_length"), F.struct(*attributes).alias(target)
    ).where("_key IS NOT NULL AND _length IS NOT NULL")
    nets = keyed.groupBy("_length", key_prefix(F.col("_key"), F.col("_length")).alias("_net")).agg(F.min(target).alias(target))
    lengths = keyed.agg(F.collect_set("_length")).scalar()
    # An address is parsed once, however many rows have it.
    tried = df.select(F.col(ip).alias("_address")).where("_address IS NOT NULL").distinct().withColumn("_key", address_key("_address"))
    tried = tried.withColumn("_lengths", lengths).select("_address", "_key", F.explode("_lengths").alias("_length"))
    met = tried.withColumn("_net", key_prefix(F.col("_key"), F.col("_length"))).join(nets, ["_length", "_net"])
    best = met.groupBy("_address").agg(F.max_by(target, "_length").alias(target))
    return salted_join(df.withColumn("_address", F.col(ip)), best, ["_address"], list(spread), "left").drop("_address")
