"""Column expressions. Every function takes and returns Column objects, so all of it stays in generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
RELATIVE_ERROR_OFFSET = 5.0
LEAKY_SLOPE = 0.01
PEAK_HOURS = ((7, 9), (17, 19))
NIGHT_HOURS = ((22, 23), (0, 5))
BAND_FACTORS = {"peak": 2.0, "night": 0.5, "normal": 1.0}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

MINUTES_PER_DAY = 24 * 60


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- scaling -----------------------------------------------------------------------------------------------

def min_max_scaled(x: Column, high: Column, low: Column, constant: str = "null") -> Column:
    """(x - low) / (high - low); a constant series gives null, or 0 with constant="zero"."""
    if constant not in ("null", "zero"):
        raise ValueError(f"constant must be null or zero, not {constant!r}")
    scaled = (x - low) / F.nullif(high - low, F.lit(0.0))
    if constant == "zero":
        return F.when(high == low, F.lit(0.0)).otherwise(scaled)
    return scaled


def min_max_restored(x: Column, high: Column, low: Column) -> Column:
    return x * (high - low) + low


# --- graph weights -----------------------------------------------------------------------------------------

def inverse_sqrt(degree: Column) -> Column:
    return F.when(degree > 0, F.lit(1.0) / F.sqrt(degree)).otherwise(F.lit(0.0))


def reciprocal(x: Column) -> Column:
    return F.when(x != 0, F.lit(1.0) / x).otherwise(F.lit(0.0))


def closeness(cost: Column) -> Column:
    """1 / cost; null where the cost is zero."""
    return F.lit(1.0) / F.nullif(cost, F.lit(0.0))


# --- errors ------------------------------------------------------------------------------------------------

def absolute_error(target: Column, prediction: Column) -> Column:
    return F.abs(target - prediction)


def relative_error(target: Column, prediction: Column) -> Column:
    return absolute_error(target, prediction) / (target + F.lit(RELATIVE_ERROR_OFFSET))


def squared_error(target: Column, prediction: Column) -> Column:
    return (target - prediction) * (target - prediction)


# --- network pieces ----------------------------------------------------------------------------------------

def relu(x: Column) -> Column:
    """Null stays null: greatest() would skip it and invent a 0."""
    return F.when(x > 0, x).when(x.isNotNull(), F.lit(0.0))


def leaky_relu(x: Column) -> Column:
    return F.when(x >= 0, x).otherwise(F.lit(LEAKY_SLOPE) * x)


def total(terms: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def dot(a: Sequence[Column | str], b: Sequence[Column | str]) -> Column:
    return total([as_column(x) * as_column(y) for x, y in zip(a, b, strict=True)])


def linear(
    columns: Sequence[Column | str], weight: Sequence[Sequence[float]], bias: Sequence[float] | None = None
) -> list[Column]:
    """One output column per column of `weight` (rows = inputs), with the weights as literals."""
    outputs = []
    for c in range(len(weight[0])):
        value = dot(columns, [F.lit(float(row[c])) for row in weight])
        outputs.append(value if bias is None else value + F.lit(float(bias[c])))
    return outputs


# --- time --------------------------------------------------------------------------------------------------

def steps_per_day(time_interval: int) -> int:
    return int(MINUTES_PER_DAY / time_interval)


def hour_of_step(t: Column, time_interval: int) -> Column:
    return F.pmod(F.floor(t * F.lit(time_interval) / F.lit(60)), F.lit(24)).cast("bigint")


def day_band(hour: Column) -> Column:
    """peak, night or normal."""

    def inside(ranges):
        return reduce(lambda a, b: a | b, [hour.between(lo, hi) for lo, hi in ranges])

    return F.when(inside(PEAK_HOURS), "peak").when(inside(NIGHT_HOURS), "night").otherwise("normal")


def band_factor(hour: Column) -> Column:
    band = day_band(hour)
    return (
        F.when(band == "peak", F.lit(BAND_FACTORS["peak"]))
        .when(band == "night", F.lit(BAND_FACTORS["night"]))
        .otherwise(F.lit(BAND_FACTORS["normal"]))
    )


def step_of(ts: Column, start: str, time_interval: int) -> Column:
    """Step index of a timestamp, counted from `start` in steps of `time_interval` minutes."""
    micros = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.lit(start).cast("timestamp"))
    return F.floor(micros / F.lit(float(time_interval * 60_000_000))).cast("bigint")


def time_of_step(t: Column, start: str, time_interval: int) -> Column:
    seconds = F.unix_seconds(F.lit(start).cast("timestamp")) + t * F.lit(time_interval * 60)
    return F.timestamp_seconds(seconds)


def formatted_time(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_FORMAT)


def parsed_time(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
