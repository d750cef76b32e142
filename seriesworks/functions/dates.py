"""Calendar expressions; every function returns columns, none needs a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesworks import config


def date_parts(d: Column) -> dict[str, Column]:
    """Calendar columns by feature name; week days count from Monday = 0."""
    month = F.month(d)
    month_start = F.dayofmonth(d) == 1
    month_end = d == F.last_day(d)
    return {
        "year": F.year(d),
        "month": month,
        "day": F.dayofmonth(d),
        "dayofweek": F.weekday(d),
        "quarter": F.quarter(d),
        "is_weekend": (F.weekday(d) >= 5).cast("int"),
        "is_month_start": month_start.cast("int"),
        "is_month_end": month_end.cast("int"),
        "is_quarter_start": (month_start & (month % 3 == 1)).cast("int"),
        "is_quarter_end": (month_end & (month % 3 == 0)).cast("int"),
        "dayofyear": F.dayofyear(d),
        "weekofyear": F.weekofyear(d),
    }


def cyclic_parts(d: Column) -> dict[str, Column]:
    month_angle = 2 * F.pi() * F.month(d) / 12
    day_angle = 2 * F.pi() * F.weekday(d) / 7
    return {
        "month_sin": F.sin(month_angle),
        "month_cos": F.cos(month_angle),
        "dayofweek_sin": F.sin(day_angle),
        "dayofweek_cos": F.cos(day_angle),
    }


def calendar_columns(
    date: str = config.DATE, features: Sequence[str] = tuple(config.DATE_FEATURES)
) -> dict[str, Column]:
    """The requested calendar features plus the four cyclic ones."""
    d = F.col(date).cast("date")
    parts = date_parts(d)
    unknown = [f for f in features if f not in parts]
    if unknown:
        raise ValueError(f"unknown date features: {unknown}")
    return {f: parts[f] for f in features} | cyclic_parts(d)


def add_calendar_features(
    df: DataFrame, date: str = config.DATE, features: Sequence[str] = tuple(config.DATE_FEATURES)
) -> DataFrame:
    return df.withColumns(calendar_columns(date, features))


def add_time_features(df: DataFrame, date: str = config.DATE) -> DataFrame:
    """The ten calendar columns without the cyclic ones."""
    parts = date_parts(F.col(date).cast("date"))
    return df.withColumns({f: parts[f] for f in config.DATE_FEATURES})


def add_holiday_features(
    df: DataFrame, date: str = config.DATE, holidays: Sequence[str] | None = None
) -> DataFrame:
    """Holiday flag, days to the nearest holiday on either side, and nearness flag.

    The holiday list is a literal in the plan: no join, no shuffle.
    """
    if holidays:
        d = F.col(date).cast("date")
        days = F.array(*[F.lit(h).cast("date") for h in sorted(set(holidays))])
        nearest = F.array_min(F.transform(days, lambda h: F.abs(F.date_diff(d, h))))
        distance = F.least(nearest, F.lit(config.HOLIDAY_DISTANCE_CAP))
        flag = F.array_contains(days, d).cast("int")
    else:
        distance = F.lit(config.HOLIDAY_DISTANCE_CAP)
        flag = F.lit(0)
    return df.withColumns(
        {
            "is_holiday": flag,
            "days_to_holiday": distance,
            "is_before_holiday": (distance <= config.HOLIDAY_NEAR_DAYS).cast("int"),
        }
    )


def compact_date(c: Column) -> Column:
    """``YYYY-MM-DD`` to ``YYYYMMDD``; text that is no date only loses its dashes."""
    text = c.cast("string")
    return F.coalesce(
        F.date_format(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")), "yyyyMMdd"),
        F.replace(text, F.lit("-"), F.lit("")),
    )


def date_range(spark: SparkSession, start: str, end: str, name: str = config.DATE) -> DataFrame:
    """Every day from start to end, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias(name))


def covered_days(df: DataFrame, date: str = config.DATE) -> DataFrame:
    """Every day from the first to the last date of a table."""
    ends = df.agg(F.min(date).alias("_first"), F.max(date).alias("_last")).where(F.col("_first").isNotNull())
    return ends.select(F.explode(F.sequence("_first", "_last")).alias(date))


def period_end(d: Column, freq: str) -> Column:
    """Last day of the period a date falls in (weeks end on Sunday)."""
    if freq == "D":
        return d
    if freq == "W":
        return F.date_add(d, 6 - F.weekday(d))
    if freq == "M":
        return F.last_day(d)
    if freq == "Q":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    raise ValueError(f"unknown frequency: {freq}")


def next_periods(end: Column, count: Column, freq: str) -> Column:
    """Array with the ``count`` period ends that follow the period end ``end``."""
    step = F.sequence(F.lit(1), count)
    if freq == "D":
        following = F.transform(step, lambda i: F.date_add(end, i))
    elif freq == "W":
        following = F.transform(step, lambda i: F.date_add(end, i * 7))
    elif freq == "M":
        following = F.transform(step, lambda i: F.last_day(F.add_months(end, i)))
    elif freq == "Q":
        following = F.transform(step, lambda i: F.last_day(F.add_months(end, i * 3)))
    else:
        raise ValueError(f"unknown frequency: {freq}")
    return F.when(count > 0, following).otherwise(F.array().cast("array<date>"))


def periods_between(start: Column, end: Column, freq: str) -> Column:
    """Number of period steps between two period ends."""
    if freq == "D":
        return F.date_diff(end, start)
    if freq == "W":
        return (F.date_diff(end, start) / 7).cast("int")
    months = (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    return months if freq == "M" else (months / 3).cast("int")
