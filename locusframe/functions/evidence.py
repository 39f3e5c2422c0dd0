"""Nullable measures: parsing, derivation and complete-evidence aggregation.

A missing measure is never zero, so every aggregate here is null unless all members are known.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ABSENT = ("", "-", "NA")
NUMBER = r"^[0-9]+(\.[0-9]+)?$"
EXACT = "decimal(24,6)"
ZONED_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"


def absent(raw: Column) -> Column:
    return raw.isNull() | raw.isin(*ABSENT)


def number(raw: Column) -> Column:
    """Plain non-negative decimal text to an exact decimal; anything else is null."""
    return F.when(raw.rlike(NUMBER), raw.try_cast(EXACT))


def malformed_number(raw: Column) -> Column:
    """Present but not a plain decimal (signs, exponents, NaN, human units and numbers too large all fail)."""
    return ~absent(raw) & number(raw).isNull()


def missing_reason(raw: Column, field: str) -> Column:
    return F.when(absent(raw), F.lit(f"trace field {field} unavailable"))


def cpu_hours(realtime_ms: Column, cpu_percent: Column) -> Column:
    """Estimated CPU hours. The percentage already spans CPUs, so no core count enters."""
    work = realtime_ms.cast("double") * cpu_percent.cast("double")
    return F.when(realtime_ms > 0, work / F.lit(360_000_000.0))


def complete(value: Column) -> Column:
    """True when a group has rows and none of them lacks the value."""
    return (F.count(F.lit(1)) > 0) & (F.count(F.lit(1)) == F.count(value))


def complete_sum(value: Column) -> Column:
    return F.when(complete(value), F.sum(value))


def complete_max(value: Column) -> Column:
    return F.when(complete(value), F.max(value))


def incomplete_reason(value: Column) -> Column:
    return (
        F.when(F.count(F.lit(1)) == 0, "no tasks")
        .when(F.count(F.lit(1)) != F.count(value), "one or more task observations unavailable")
    )


def zoned_epoch_micros(text: Column) -> Column:
    """Epoch microseconds of a timestamp that names its zone; null when the zone is missing."""
    return F.when(text.rlike(ZONED_TIME), F.unix_micros(F.try_to_timestamp(text)))


def wall_seconds(observed: Column, start: Column, end: Column) -> Column:
    """Wall time from exactly one of two sources."""
    first, last = zoned_epoch_micros(start), zoned_epoch_micros(end)
    return F.when(observed.isNull(), (last - first) / F.lit(1e6)).when(
        start.isNull() & end.isNull(), observed
    )


def wall_source(observed: Column, start: Column, end: Column) -> Column:
    """Provenance of the wall time, or the name of the broken rule."""
    return (
        F.when(observed.isNotNull() & (start.isNotNull() | end.isNotNull()), "invalid:two_sources")
        .when(start.isNull() != end.isNull(), "invalid:half_interval")
        .when(observed.isNotNull(), "provided_observation")
        .when(start.isNull(), "unavailable")
        .when(zoned_epoch_micros(start).isNull() | zoned_epoch_micros(end).isNull(), "invalid:zone")
        .otherwise("provided_invocation_timestamps")
    )


def reservation_floor(
    wall_s: Column, grace_s: Column, cpus: Column, cpu_hour: Decimal, gib: Column, gib_hour: Decimal, retry: Decimal
) -> Column:
    """Smallest reservation covering compute, storage and the retry reserve, in exact decimals."""
    hourly = cpus.cast("decimal(10,0)") * F.lit(cpu_hour) + gib.cast("decimal(10,0)") * F.lit(gib_hour)
    seconds = (wall_s + grace_s).cast("decimal(12,0)")
    return (seconds * hourly / F.lit(Decimal(3600)) + F.lit(retry)).cast("decimal(18,6)")


def canonical_hash(*columns: str) -> Column:
    """SHA-256 over the named columns as compact JSON with keys in sorted order."""
    ordered = [F.col(name) for name in sorted(columns)]
    return F.sha2(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}), 256)
