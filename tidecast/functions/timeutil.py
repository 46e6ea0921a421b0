"""Time functions on zone-less timestamps.

Every expression works on the calendar fields of a ``timestamp_ntz`` value, so
results do not depend on ``spark.sql.session.timeZone`` and stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidecast.functions.fixed_values import RUSH_HOURS, WEEKEND_DAYS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def midnight(ts: Column | str) -> Column:
    return F.to_date(_col(ts)).cast("timestamp_ntz")


def plus_hours(ts: Column | str, hours: Column | int) -> Column:
    step = hours if isinstance(hours, Column) else F.lit(hours)
    return _col(ts) + F.make_dt_interval(F.lit(0), step)


def hour_bucket(ts: Column | str, mode: str = "round") -> Column:
    """Hour a timestamp belongs to.

    ``round`` is the nearest hour with exact half hours going to the even hour;
    ``floor`` truncates. A day has an even number of hours, so the parity of the
    hour of day equals the parity of the hour since the epoch.
    """
    ts = _col(ts)
    hour = F.hour(ts)
    if mode == "floor":
        return plus_hours(midnight(ts), hour)
    if mode != "round":
        raise ValueError(f"unknown bucket mode: {mode}")
    minute = F.minute(ts)
    # date_part keeps the fraction, second() would cut it off
    second = F.date_part(F.lit("SECOND"), ts)
    up = (minute > 30) | ((minute == 30) & ((second > 0) | (hour % 2 == 1)))
    return plus_hours(midnight(ts), hour + up.cast("int"))


def time_block(ts: Column | str, unit: str) -> Column:
    """Start of the hour, day, month or year of a zone-less timestamp."""
    if unit == "hour":
        return hour_bucket(ts, "floor")
    if unit == "day":
        return midnight(ts)
    if unit in ("month", "year"):
        return F.trunc(F.to_date(_col(ts)), unit).cast("timestamp_ntz")
    raise ValueError(f"unknown time block: {unit}")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of a zone-less timestamp."""
    ts = _col(ts)
    days = F.unix_date(F.to_date(ts)).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Full hours from start to end (truncated toward zero)."""
    diff = epoch_seconds(end) - epoch_seconds(start)
    return (diff / 3600).cast("long")


def month_end_hour(ts: Column | str) -> Column:
    """Last full hour (23:00) of the month of ``ts``."""
    return plus_hours(F.last_day(F.to_date(_col(ts))).cast("timestamp_ntz"), 23)


def parse_timestamp(text: Column | str, pattern: str) -> Column:
    return F.to_timestamp_ntz(_col(text), F.lit(pattern))


def week_day(ts: Column | str) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_col(ts))


def weekend_flag(ts: Column | str) -> Column:
    return week_day(ts).isin(WEEKEND_DAYS).cast("int")


def rush_hour_flag(ts: Column | str) -> Column:
    ts = _col(ts)
    return (F.hour(ts).isin(RUSH_HOURS) & ~week_day(ts).isin(WEEKEND_DAYS)).cast("int")


def _fixed_date_holiday(day: Column) -> Column:
    month, dom = F.month(day), F.day(day)
    return (
        ((month == 1) & (dom == 1))
        | ((month == 6) & (dom == 19) & (F.year(day) >= 2021))
        | ((month == 7) & (dom == 4))
        | ((month == 11) & (dom == 11))
        | ((month == 12) & (dom == 25))
    )


def is_us_holiday(day: Column | str, include_actual: bool = False) -> Column:
    """Whether a date is a US federal holiday, from the calendar rules alone.

    Fixed dates move to Friday when they fall on Saturday and to Monday when
    they fall on Sunday. ``include_actual`` also keeps the unmoved date. Being a
    rule, it needs no holiday table, no join and no year range.
    """
    day = F.to_date(_col(day))
    month, dom, dow = F.month(day), F.day(day), F.weekday(day)

    def nth(which_month: int, which_dow: int, first: int, last: int) -> Column:
        return (month == which_month) & (dow == which_dow) & dom.between(first, last)

    moving = (
        nth(1, 0, 15, 21)
        | nth(2, 0, 15, 21)
        | nth(5, 0, 25, 31)
        | nth(9, 0, 1, 7)
        | nth(10, 0, 8, 14)
        | nth(11, 3, 22, 28)
    )
    fixed = _fixed_date_holiday(day)
    observed = (
        (fixed & (dow < 5))
        | ((dow == 4) & _fixed_date_holiday(F.date_add(day, 1)))
        | ((dow == 0) & _fixed_date_holiday(F.date_sub(day, 1)))
    )
    return moving | observed | (fixed if include_actual else F.lit(False))


def us_holidays(df: DataFrame, first: str, last: str, include_actual: bool = False) -> DataFrame:
    """Holiday dates between the smallest ``first`` and the largest ``last`` date of ``df``."""
    span = df.agg(F.to_date(F.min(first)).alias("lo"), F.to_date(F.max(last)).alias("hi"))
    return span.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("holiday")
    ).where(is_us_holiday("holiday", include_actual))


def calendar_features(ts: str, include_actual: bool = True) -> dict[str, Column]:
    """Calendar columns of an hour key, all computed from the key itself.

    A holiday moved from a weekend counts on both dates; ``include_actual=False`` keeps
    the observed one only.
    """
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": week_day(ts),
        "day_of_month": F.day(ts),
        "is_weekend": weekend_flag(ts),
        "is_holiday": is_us_holiday(ts, include_actual).cast("int"),
        "is_rush_hour": rush_hour_flag(ts),
    }


def date_parts(ts: str, prefix: str = "transaction_") -> dict[str, Column]:
    return {
        f"{prefix}date": F.to_date(ts),
        f"{prefix}year": F.year(ts),
        f"{prefix}month": F.month(ts),
        f"{prefix}day": F.day(ts),
        f"{prefix}hour": F.hour(ts),
    }
