"""Number rendering for alert texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SI prefixes above and below one.
LARGE = ["", "k", "M", "G", "T", "P", "E", "Z", "Y"]
SMALL = ["", "m", "u", "n", "p", "f", "a", "z", "y"]


def significant(v: Column, digits: int = 4) -> Column:
    """Four significant digits, no trailing zeros; an exponent outside 1e-4..1e4.

    A tie is judged on the shortest decimal form of the number and rounds up."""
    size = F.when(v == 0, F.lit(0)).otherwise(F.floor(F.log10(F.abs(v))).cast("int"))
    # Rounding can carry into the next power of ten (9.99996 -> 10).
    places = F.lit(digits - 1) - size
    rounded = F.round(v * F.pow(F.lit(10.0), places)) / F.pow(F.lit(10.0), places)
    text = F.format_string("%.10f", rounded)
    trimmed = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    # Beyond the fixed range the exponent form is used.
    exact = F.format_string(f"%.{digits - 1}e", v)
    mantissa = F.regexp_replace(F.regexp_replace(F.split(exact, "e")[0], r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return (
        F.when(v == 0, "0")
        .when(F.isnan(v), "NaN")
        .when(v == float("inf"), "+Inf")
        .when(v == float("-inf"), "-Inf")
        .when((F.abs(v) >= 1.0e4) | (F.abs(v) < 1.0e-4), F.concat(mantissa, F.lit("e"), F.split(exact, "e")[1]))
        .otherwise(trimmed)
    )


def plain(v: Column) -> Column:
    """Shortest digits without an exponent or a trailing ``.0``."""
    short = v.cast("string")
    wide = v.try_cast("decimal(38,16)").cast("string")
    text = F.when(short.contains("E") & wide.isNotNull(), F.regexp_replace(wide, r"0+$", "")).otherwise(short)
    return F.regexp_replace(text, r"\.0?$", "")


def humanize(v: Column) -> Column:
    """Four significant digits with an SI prefix."""
    size = F.abs(v)
    power = F.floor(F.log10(size) / 3.0).cast("int")
    # log10 of an exact power may land a hair below it.
    power = F.when(size >= F.pow(F.lit(1000.0), power + 1), power + 1).otherwise(power)
    power = F.greatest(F.least(power, F.lit(8)), F.lit(-8))
    scaled = v / F.pow(F.lit(1000.0), power)
    prefix = F.when(
        power >= 0, F.element_at(F.array(*[F.lit(x) for x in LARGE]), F.greatest(power, F.lit(0)) + 1)
    ).otherwise(F.element_at(F.array(*[F.lit(x) for x in SMALL]), F.greatest(-power, F.lit(0)) + 1))
    return F.when((v == 0) | F.isnan(v) | (size == float("inf")), significant(v)).otherwise(F.concat(significant(scaled), prefix))


def humanize_percentage(v: Column) -> Column:
    return F.concat(significant(v * 100.0), F.lit("%"))


def humanize_duration(v: Column) -> Column:
    """``1d 2h 3m 4s`` above a minute, ``12.5s`` above a second, prefixed below."""
    size = F.abs(v)
    whole = F.floor(size).cast("long")
    sign = F.when(v < 0, "-").otherwise("")
    s, m, h = whole % 60, F.floor(whole / 60) % 60, F.floor(whole / 3600) % 24
    d = F.floor(whole / 86400)
    text = lambda n, unit: F.concat(n.cast("long").cast("string"), F.lit(unit))
    tail = F.concat(text(m, "m "), text(s, "s"))
    long = (
        F.when(d > 0, F.concat(text(d, "d "), text(h, "h "), tail))
        .when(h > 0, F.concat(text(h, "h "), tail))
        .when(m > 0, tail)
    )
    return (
        F.when(v == 0, "0s")
        .when(size >= 60, F.concat(sign, long))
        .when(size >= 1, F.concat(significant(v), F.lit("s")))
        .otherwise(F.concat(humanize(v), F.lit("s")))
    )
