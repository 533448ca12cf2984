from datetime import datetime, timedelta, timezone

import numpy as np

UTC = timezone.utc


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def hours(start, n):
    first = at(start)
    return [first + timedelta(hours=i) for i in range(n)]


def series_rows(n_hours, n_zones, seed=42, start="2025-01-01"):
    """Daily and weekly cycle plus seeded noise, with the calendar columns."""
    rng = np.random.default_rng(seed)
    rows = []
    for zone in range(n_zones):
        for t in hours(start, n_hours):
            demand = 2000 + 200 * zone + 500 * np.sin(2 * np.pi * t.hour / 24) + 200 * np.sin(2 * np.pi * t.weekday() / 7)
            rows.append(
                (t, float(demand + 50 * rng.standard_normal()), zone, float(15 + zone + 5 * rng.standard_normal()),
                 t.hour, t.weekday(), t.month, int(t.weekday() >= 5), 0)
            )
    return rows


SERIES_DDL = (
    "date timestamp, demand double, sub_region_code bigint, temperature_2m double, hour bigint, day_of_week bigint, "
    "month bigint, is_weekend bigint, is_holiday bigint"
)


def series(spark, n_hours=1500, n_zones=2, **kw):
    return spark.createDataFrame(series_rows(n_hours, n_zones, **kw), SERIES_DDL)


def values(df, *columns):
    """Rows as sorted tuples; timestamps as naive UTC text."""
    out = []
    for r in df.select(*columns).collect():
        out.append(tuple(str(v) if isinstance(v, datetime) else v for v in r))
    return sorted(out, key=repr)
