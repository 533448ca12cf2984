"""Small scalar expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized_name(name: str) -> str:
    """Lower case, then ``-`` and blanks to ``_``, then strip; an edge blank therefore ends up as ``_``."""
    return name.lower().replace("-", "_").replace(" ", "_").strip()


def parse_utc(text: Column) -> Column:
    """Parse ``yyyy-MM-ddTHH`` or an ISO timestamp; text that is no timestamp gives null."""
    return F.try_to_timestamp(text)


def to_number(text: Column) -> Column:
    """Numeric coercion: what is no number becomes null."""
    return text.try_cast("double")


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def iso_string(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss")


def naive(time: Column) -> Column:
    """Drop the zone: the UTC wall clock as ``timestamp_ntz``."""
    return time.cast("timestamp_ntz")


def eastern(time: Column) -> Column:
    """The US Eastern wall clock of a UTC timestamp, daylight saving included."""
    return F.from_utc_timestamp(time, "America/New_York")


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded down."""
    return F.floor((F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 86400)


def round_half_even(x: Column, scale: int = 0) -> Column:
    return F.bround(x, scale)


def json_number(doc: Column, path: str, default: float) -> Column:
    """A number inside a JSON text, or the default when the document or the field is missing."""
    return F.coalesce(F.get_json_object(doc, path).try_cast("double"), F.lit(float(default)))


def color_scale(x: Column, lowest: Column, highest: Column) -> Column:
    """An RGBA array from green-blue (lowest) to red (highest); the middle colour when all values are equal."""
    share = F.when(highest != lowest, (x - lowest) / (highest - lowest)).otherwise(F.lit(0.5))
    return F.array((share * 255).cast("int"), ((1 - share) * 200).cast("int"), F.lit(50), F.lit(200))


def exact_sum(x: Column, scale: int) -> Column:
    """Sum of numbers with at most ``scale`` decimals, free of rounding error and so of the order of the rows.

    Whole multiples of the last decimal are added as bigint, which stays a primitive in generated code.
    """
    unit = float(10**scale)
    return F.sum(F.rint(x.cast("double") * unit).cast("bigint")).cast("double") / F.lit(unit)
