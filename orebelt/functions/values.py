"""Value expressions: blanks, sentinels, dates, ratios, labels, JSON fields."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from orebelt.contract import NO_DATE, NO_KEY


def blank_to_null(value: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def or_sentinel(value: Column, sentinel: int = NO_KEY) -> Column:
    """Integer key with the sentinel in place of NULL."""
    return F.coalesce(value, F.lit(sentinel)).cast("int")


def ratio(part: Column, whole: Column, default: float | None = None) -> Column:
    """``part / whole``; the default where the whole is zero or missing."""
    return F.when(whole != 0, part.cast("double") / whole).otherwise(F.lit(default).cast("double"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two wall-clock times, NULL if either is missing.

    Subtracting local timestamps does not involve the session time zone, so hours
    that a zone skips or repeats do not distort trips.
    """
    gap = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    return reduce(Column.__add__, [F.extract(F.lit(unit), gap).cast("bigint") * n for unit, n in parts.items()])


def elapsed_minutes(start: Column, end: Column) -> Column:
    return elapsed_seconds(start, end) / F.lit(60.0)


def month_key(moment: Column, year: Column, month: Column) -> Column:
    """``yyyy-MM`` of the timestamp, else of a plausible year and month, else the sentinel."""
    plausible = year.between(1900, 2200) & month.between(1, 12)
    return F.coalesce(
        F.when(moment.isNotNull(), F.format_string("%04d-%02d", F.year(moment), F.month(moment))),
        F.when(plausible, F.format_string("%04d-%02d", year, month)),
        F.lit(NO_DATE),
    )


def hour_key(hour: Column, moment: Column) -> Column:
    """Hour of day in 0–23, sentinel otherwise."""
    value = F.coalesce(hour, F.hour(moment))
    return F.when(value.between(0, 23), value.cast("int")).otherwise(F.lit(NO_KEY))


def label_of(key: Column, labels: Mapping, fallback: Column) -> Column:
    """Catalog label by literal map; small fixed catalogs need no join."""
    pairs = [F.lit(item) for entry in labels.items() for item in entry]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), fallback)


def json_fields(document: Column, schema: str) -> Column:
    """Struct of the named fields; every field is NULL when the text is not valid JSON."""
    return F.from_json(document, schema, {"mode": "PERMISSIVE"})


def share_of(value: Column, lower: float, upper: float) -> Column:
    """1 inside the closed range, 0 outside or NULL."""
    return F.coalesce(value.between(lower, upper), F.lit(False)).cast("long")
