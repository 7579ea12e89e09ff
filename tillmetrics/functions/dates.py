"""Calendar helpers: weeks, months, labels and tolerant date parsing."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, functions as F

from tillmetrics.fixed import REPORT_TIME_ZONE


def parse_day(text: Column) -> Column:
    """``YYYY-MM-DD`` first, then ``MM-DD-YYYY``; NULL for anything else."""
    return F.coalesce(
        F.try_to_timestamp(text, F.lit("yyyy-M-d")).cast("date"),
        F.try_to_timestamp(text, F.lit("M-d-yyyy")).cast("date"),
    )


def iso_day(text: Column) -> Column:
    """Calendar day written at the start of a text, offset ignored.

    ISO-8601 days in all forms (2026-01-19, 20260119, 2026-W04-1, 2026W041; a week
    alone is its Monday), and year, month and day of one or two digits that fill
    the first ten characters.
    """
    dashed = F.substring(text, 1, 10)
    compact = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    week = r"^(\d{4})-?W(\d{2})(?:-?([1-7]))?(?:[^\d-].*)?$"
    year, number, day = (F.regexp_extract(text, week, i).try_cast("int") for i in (1, 2, 3))
    fourth = F.concat(year.cast("string"), F.lit("-01-04")).try_cast("date")
    monday = F.date_add(week_start(fourth), (number - 1) * 7)
    return (
        F.when(dashed.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), dashed.try_cast("date"))
        .when(text.rlike(r"^\d{8}(?:\D.*)?$"), compact.try_cast("date"))
        .when(text.rlike(week) & (iso_week(monday) == number), F.date_add(monday, F.coalesce(day, F.lit(1)) - 1))
    )


def written_between(text: Column, start: str | None, end: str | None) -> Column:
    """Whether an ISO-8601 text lies on a day from ``start`` to ``end``, as written.

    A comparison of texts, which Spark hands to the statistics of Parquet files. It
    is right for ISO texts only; use it in front of a filter on the parsed day.
    """
    wanted = F.lit(True)
    if start is not None:
        wanted = text >= start
    if end is not None:
        after = date.fromisoformat(end) + timedelta(days=1)
        wanted = (wanted & (text < after.isoformat())) if start is not None else text < after.isoformat()
    return wanted


def week_start(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def week_end(day: Column) -> Column:
    return F.date_add(week_start(day), 6)


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def week_label(day: Column, legacy: bool = False) -> Column:
    """``W07-2026``. The year is the ISO year, so that the label is unique.

    ``legacy`` uses the calendar year of the Monday instead; then 2024-01-01 and
    2024-12-30 share one label.
    """
    year = F.year(week_start(day)) if legacy else F.extract(F.lit("YEAROFWEEK"), day)
    return F.concat(F.lit("W"), F.lpad(iso_week(day).cast("string"), 2, "0"), F.lit("-"), year.cast("string"))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def range_label(start: Column, end: Column) -> Column:
    """``January 19-January 25, 2026``."""
    return F.concat(F.date_format(start, "MMMM d"), F.lit("-"), F.date_format(end, "MMMM d, yyyy"))


def local_today(zone: str = REPORT_TIME_ZONE, now: Column | None = None) -> Column:
    """The day in the report's zone, at the session's clock or at the TIMESTAMP ``now``."""
    moment = F.current_timestamp() if now is None else now
    return F.from_utc_timestamp(F.to_utc_timestamp(moment, F.current_timezone()), zone).cast("date")


def last_week(day: Column) -> tuple[Column, Column]:
    """Monday and Sunday of the week before ``day``."""
    monday = F.date_sub(week_start(day), 7)
    return monday, F.date_add(monday, 6)


def period_array(mode: str, day: Column, legacy_label: bool = False) -> Column:
    """The week and/or month around ``day`` as an array of structs to explode."""
    week = F.struct(
        F.lit("WEEK").alias("period_type"),
        week_label(day, legacy_label).alias("period_label"),
        week_start(day).alias("start_date"),
        week_end(day).alias("end_date"),
    )
    month = F.struct(
        F.lit("MONTH").alias("period_type"),
        month_label(day).alias("period_label"),
        F.trunc(day, "month").alias("start_date"),
        F.last_day(day).alias("end_date"),
    )
    wanted = {"weekly": [week], "monthly": [month]}.get(mode, [week, month])
    return F.array(*wanted)
