"""Date and time expressions. Every "now" is an explicit ``as_of`` argument."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_MICROS = 86_400_000_000
DAY_SECONDS = 86_400


def instant(text: str) -> Column:
    """Zone-free timestamp literal, the type of the domain tables."""
    return F.lit(text).cast("timestamp_ntz")


def shift(ts: Column, amount: int, unit: str) -> Column:
    """``ts`` plus calendar months or exact days, hours or minutes."""
    if unit == "month":
        return ts + F.make_ym_interval(F.lit(0), F.lit(amount))
    parts = {"day": 0, "hour": 0, "minute": 0}
    parts[unit] = amount
    return ts + F.make_dt_interval(*(F.lit(parts[p]) for p in ("day", "hour", "minute")))


def month_start(ts: Column) -> Column:
    return F.date_trunc("month", ts).cast("date")


def hour_start(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def micros_between(start: Column, end: Column) -> Column:
    return F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))


def days_between(start: Column, end: Column) -> Column:
    """Elapsed days as a fraction."""
    return micros_between(start, end).cast("double") / F.lit(float(DAY_MICROS))


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour days, cut towards zero (not the number of midnights passed)."""
    return F.timestamp_diff("DAY", start, end).cast("int")


def floor_days(start: Column, end: Column) -> Column:
    """Full 24-hour days, rounded down also for negative spans."""
    span = micros_between(start, end)
    return F.call_function("div", span - F.pmod(span, F.lit(DAY_MICROS)), F.lit(DAY_MICROS))


def mean_days(start: Column, end: Column) -> Column:
    """Aggregate: mean elapsed days to two places, half away from zero, in integer arithmetic."""
    seconds = F.sum(F.timestamp_diff("SECOND", start, end))
    pairs = F.count(F.timestamp_diff("SECOND", start, end))
    return mean_days_of(seconds, pairs)


def mean_days_of(seconds: Column, pairs: Column) -> Column:
    """Two-place mean of ``pairs`` spans lasting ``seconds`` together; NULL without pairs."""
    return mean_hundredths(100 * seconds.cast("decimal(28,0)"), DAY_SECONDS * pairs.cast("decimal(28,0)")).cast(
        "decimal(10,2)")


def mean_hundredths(hundredths: Column, n: Column) -> Column:
    """``hundredths`` / ``n`` rounded once, half away from zero, as a number with two decimals."""
    doubled = 2 * F.abs(hundredths) + n
    whole = F.call_function("div", doubled, 2 * F.nullif(n, F.lit(0))) * F.sign(hundredths).cast("long")
    return (whole.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def lenient_timestamp(text: Column, pattern: str | None = None) -> Column:
    """Parsed timestamp, or NULL where the text is no date."""
    parsed = F.try_to_timestamp(text, F.lit(pattern)) if pattern else F.try_to_timestamp(text)
    return parsed.cast("timestamp_ntz")


def month_partition_name(year: Column, month: Column) -> Column:
    return F.format_string("order_%s_%s", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def month_partition_bounds(year: Column, month: Column) -> tuple[Column, Column]:
    """First instant of the month and of the next one."""
    zero = F.lit(0)
    first = F.make_timestamp_ntz(year, month, F.lit(1), zero, zero, zero)
    return first, shift(first, 1, "month")
