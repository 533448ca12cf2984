"""Column expressions; every one of them stays inside the JVM."""

from hourline.functions.calendar import (
    calendar_columns,
    federal_holidays,
    is_federal_holiday,
    is_holiday,
    is_weekend,
)
from hourline.functions.scalars import (
    color_scale,
    days_between,
    eastern,
    exact_sum,
    from_epoch,
    iso_string,
    json_number,
    naive,
    normalized_name,
    parse_utc,
    round_half_even,
    to_number,
)

__all__ = [
    "calendar_columns",
    "color_scale",
    "days_between",
    "eastern",
    "exact_sum",
    "federal_holidays",
    "from_epoch",
    "is_federal_holiday",
    "is_holiday",
    "is_weekend",
    "iso_string",
    "json_number",
    "naive",
    "normalized_name",
    "parse_utc",
    "round_half_even",
    "to_number",
]
