"""Predicates over arrays, maps and time ranges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def has_tag(tags: Column, tag: str) -> Column:
    return F.array_contains(tags, tag)


def any_tag(tags: Column, wanted: list[str]) -> Column:
    """At least one wanted element; false, not NULL, where only NULL elements prevent a match."""
    return F.when(tags.isNotNull(), F.coalesce(F.arrays_overlap(tags, F.lit(wanted)), F.lit(False)))


def all_tags(tags: Column, wanted: list[str]) -> Column:
    return F.size(F.array_except(F.lit(wanted), tags)) == 0


def no_elements(values: Column) -> Column:
    return values.isNull() | (F.size(values) == 0)


def element_count(values: Column) -> Column:
    """Length of an array, NULL for an empty one."""
    return F.when(F.size(values) > 0, F.size(values))


def map_value(entries: Column, key: str) -> Column:
    return F.try_element_at(entries, F.lit(key))


def period(lower: Column, upper: Column, bounds: str = "[)") -> Column:
    """Time range; a NULL bound is open-ended."""
    return F.struct(
        lower.alias("lower"), upper.alias("upper"),
        F.lit(bounds[0] == "[").alias("lower_inc"), F.lit(bounds[1] == "]").alias("upper_inc"))


def period_is_empty(p: Column) -> Column:
    lo, hi = p["lower"], p["upper"]
    return F.coalesce((lo > hi) | ((lo == hi) & ~(p["lower_inc"] & p["upper_inc"])), F.lit(False))


def period_contains(p: Column, at: Column) -> Column:
    lo, hi = p["lower"], p["upper"]
    after = lo.isNull() | (lo < at) | (p["lower_inc"] & (lo == at))
    before = hi.isNull() | (at < hi) | (p["upper_inc"] & (hi == at))
    return after & before


def periods_overlap(p: Column, q: Column) -> Column:
    def starts_before_end(a: Column, b: Column) -> Column:
        touch = a["lower_inc"] & b["upper_inc"] & (a["lower"] == b["upper"])
        return a["lower"].isNull() | b["upper"].isNull() | (a["lower"] < b["upper"]) | touch

    return (starts_before_end(p, q) & starts_before_end(q, p)
            & ~period_is_empty(p) & ~period_is_empty(q))
