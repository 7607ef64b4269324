"""Names and values of logged metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which utilisation samples are kept, and how devices are written in their keys.
KEPT_STATISTIC = "mean"
IGNORED_PARTS = ("load_average", "fan_speed", "pid")
DEVICE_MARK = "gpu"
DEVICE_PATTERN = r"/gpu:\d+/"
HOST = "host"


def prefixed(name: Column, prefix: str) -> Column:
    return F.concat(F.lit(f"{prefix}_"), F.replace(name, F.lit("test_"), F.lit("")))


def logged_value(text: Column) -> Column:
    """Metrics are logged as strings; what is not a number becomes null."""
    return text.try_cast("double")


def first_number(text: Column) -> Column:
    """A metric logged as text: its number, or the first one of a list of numbers; null if it is neither."""
    return F.coalesce(logged_value(text), F.get(F.from_json(text, "array<double>"), F.lit(0)))


def usable(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def is_kept_sample(key: Column) -> Column:
    kept = F.contains(key, F.lit(KEPT_STATISTIC))
    for part in IGNORED_PARTS:
        kept = kept & ~F.contains(key, F.lit(part))
    return kept


def normal_key(key: Column) -> Column:
    """The part before the first blank, marked when the sample is a percentage."""
    return F.concat(
        F.split(key, " ")[0], F.when(F.contains(key, F.lit("%")), F.lit(" %")).otherwise(F.lit(""))
    )


def normal_value(value: Column) -> Column:
    """Two decimals, half to even; a missing sample counts as 0, NaN stays."""
    return F.when(F.isnan(value), value).otherwise(F.coalesce(F.bround(value, 2), F.lit(0.0)))


def device_of(name: Column) -> Column:
    """Device part of a normalised key; keys without one belong to the host."""
    found = F.regexp_extract(name, DEVICE_PATTERN, 0)
    return F.when(F.contains(name, F.lit(DEVICE_MARK)) & (found != ""), found).otherwise(F.lit(HOST))


def family_of(name: Column) -> Column:
    """Which utilisation row of the device a normalised key belongs to."""
    return (
        F.when(F.contains(name, F.lit("%")), F.lit("utilization"))
        .when(F.contains(name, F.lit("memory")), F.lit("memory"))
        .otherwise(F.lit("other"))
    )
