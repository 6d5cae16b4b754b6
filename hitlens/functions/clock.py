"""Time parts, day periods, arrival times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import ladder


def parts(ts: Column) -> dict[str, Column]:
    """Calendar parts; weekday counts Monday as 1, week is the ISO week."""
    weekday = F.weekday(ts) + 1
    return {
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "second": F.second(ts),
        "quarter": F.quarter(ts),
        "week": F.weekofyear(ts),
        "day_of_year": F.dayofyear(ts),
        "weekday": weekday,
        "is_weekend": weekday >= 6,
        "date_hour": F.date_format(ts, "yyyy-MM-dd HH"),
        "date_hour_minute": F.date_format(ts, "yyyy-MM-dd HH:mm"),
    }


def day_period(hour: Column) -> Column:
    return ladder(hour, K.DAY_PERIOD, "Night", strict=True)


def business_period(hour: Column) -> Column:
    return ladder(hour, K.BUSINESS_PERIOD, "夜间活跃", strict=True)


def business_hours(weekday: Column, hour: Column) -> Column:
    workday = weekday <= 5
    near = hour.between(7, 8) | hour.between(18, 20)
    return (
        F.when(workday & hour.between(9, 17), F.lit("business_hours"))
        .when(workday & near, F.lit("extended_hours"))
        .when(~workday & hour.between(10, 18), F.lit("weekend_hours"))
        .otherwise(F.lit("off_hours"))
    )


def traffic_pattern(weekday: Column, hour: Column) -> Column:
    workday = weekday <= 5
    return (
        F.when(workday & (hour.between(9, 11) | hour.between(14, 16)), F.lit("peak"))
        .when(workday & hour.between(8, 18), F.lit("normal"))
        .otherwise(F.lit("off_peak"))
    )


def arrival(completed: Column, duration_ms: Column) -> Column:
    """Completion time less the request duration."""
    return F.timestamp_add("MILLISECOND", -duration_ms, completed)


def wall_clock(text: Column) -> Column:
    """ISO text with its offset removed (not converted), NULL if unreadable."""
    plain = F.replace(F.substring(text, 1, 19), F.lit("T"), F.lit(" "))
    form = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([+-]\d{2}:\d{2})?$")
    return F.when(form, plain.try_cast("timestamp"))


def bucket(ts: Column, grain: str) -> Column:
    """Start of the second, minute, hour or day."""
    return F.date_trunc(grain, ts)
