"""Review times: one parser for epochs of several units and for written dates."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Written forms by what they look like: only a form that fits is tried, as failed attempts cost far more than a look.
FORMATS = (("^[0-9]{4}/[0-9]+/[0-9]+ ", "yyyy/MM/dd HH:mm:ss"), ("^[0-9]{4}/[0-9]+/[0-9]+$", "yyyy/MM/dd"))
ISO = r"^\s*[0-9]{4}-"
NUMERIC = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(text: str | Column) -> Column:
    """A column of texts as doubles where they are written as numbers, else null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(text.rlike(NUMERIC), text.try_cast("double"))


def parse(text: str | Column, micro: bool = False, formats: tuple[tuple[str, str], ...] = FORMATS) -> Column:
    """The time in a column of texts: seconds, milliseconds above 1e11, with `micro` microseconds above 1e14; then written forms; else null."""
    text = F.col(text) if isinstance(text, str) else text
    x = number(text)
    epoch = F.when(x > 1e11, x / 1000).otherwise(x)
    if micro:
        epoch = F.when(x > 1e14, x / 1_000_000).otherwise(epoch)
    written = [
        F.when(text.rlike(ISO), text.try_cast("timestamp")),
        *(F.when(text.rlike(look), F.try_to_timestamp(text, F.lit(f))) for look, f in formats)]
    return F.when(x.isNotNull(), F.timestamp_seconds(epoch)).otherwise(F.coalesce(*written))


def seconds_day(text: str) -> Column:
    """The day of an epoch in seconds; nothing else counts, and a number above 1e11 is no such epoch."""
    x = number(text)
    return F.to_date(F.timestamp_seconds(F.when(x <= 1e11, x)))


def bucket(grain: str, time: Column) -> Column:
    """The first day of the day, week (from Monday) or month."""
    return F.date_trunc(grain, time).cast("date")


def sunday_week(day: Column) -> Column:
    return F.date_sub(day, F.dayofweek(day) - 1)


def month_end_bin(day: Column) -> Column:
    """The month end that a bin [month end, next month end) is named by."""
    return F.when(day == F.last_day(day), day).otherwise(F.last_day(F.add_months(day, -1)))


def audited(rows, column: str):
    """rows with `time`: digits alone are an epoch, in milliseconds if their median is above 1e12; other values are written dates.

    The median is approximate to a ten-thousandth of the rows, as only its size counts; it is one row."""
    digits = F.col(column).rlike("^[0-9]+$")
    x = F.when(digits, F.col(column).try_cast("double"))
    middle = rows.agg(F.percentile_approx(x, 0.5, 10_000).alias("__median"))
    unit = F.when(F.col("__median") > 1e12, 1000).otherwise(1)
    time = F.when(digits, F.timestamp_seconds(x / unit)).otherwise(parse(column))
    return rows.join(F.broadcast(middle)).withColumn("time", time).drop("__median")
