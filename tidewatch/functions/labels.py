"""Label maps as keys. Maps cannot be grouped, their canonical text can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENTRY = "array<struct<key:string,value:string>>"


def series_key(labels: Column | str) -> Column:
    """Canonical text of a label map: entries sorted by name."""
    c = F.col(labels) if isinstance(labels, str) else labels
    return F.to_json(F.array_sort(F.map_entries(c)))


def labels_of(series: Column | str) -> Column:
    """Label map back from its canonical text."""
    c = F.col(series) if isinstance(series, str) else series
    return F.map_from_entries(F.from_json(c, ENTRY))


def without(labels: Column, *names: str) -> Column:
    return F.map_filter(labels, lambda k, _: ~k.isin(*names)) if names else labels


def render(labels: Column | str) -> Column:
    """``a=1,b=2`` in name order."""
    c = F.col(labels) if isinstance(labels, str) else labels
    return F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
