"""Array, map and dense-series builders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL = "All"


def array_agg_ordered(value: Column, *order: Column, descending: bool = False) -> Column:
    """Aggregate values into an array in a given order, NULL values kept.

    The sort key is a struct, so ``order`` must make rows unique for a stable result.
    Use only on groups of bounded size.
    """
    key = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    items = F.sort_array(F.collect_list(F.struct(key.alias("k"), value.alias("v"))), asc=not descending)
    return F.transform(items, lambda item: item["v"])


def object_agg(key: Column, value: Column) -> Column:
    """Aggregate (key, value) pairs, unique by key, into a map in key order."""
    pairs = F.collect_list(F.struct(key.alias("key"), value.alias("value")))
    return F.map_from_entries(F.array_sort(pairs, lambda a, b: _by_key(a["key"], b["key"])))


def object_agg_all_first(category: Column, value: Column) -> Column:
    """Like :func:`object_agg`, with the 'All' entry first and the categories after it."""
    pairs = F.collect_list(F.struct(all_first(category).alias("o"), category.alias("key"), value.alias("value")))
    ordered = F.array_sort(pairs, lambda a, b: _by_key(a["o"], b["o"]))
    return F.map_from_entries(F.transform(ordered, lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))))


def all_first(category: Column) -> Column:
    """Sort key: 'All' before every category."""
    return F.struct(F.when(category == ALL, 0).otherwise(1).alias("rank"), category.alias("category"))


def _by_key(a: Column, b: Column) -> Column:
    return F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)).otherwise(F.lit(0))


def day_sequence(start: Column, end: Column) -> Column:
    """Every day from ``start`` to ``end``, both included."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def fill_series(points: Column, start: Column, end: Column, fill: str = "lag1", zero: Column | None = None) -> Column:
    """Sparse (day, value) points to one value per day of [start, end], as an array.

    ``points`` is an array of structs (day date, value), unique by day. Each known point
    owns the stretch up to the next one, so the work is linear in the number of days.

    ``lag1``: a day without a value takes the value of the day before it; further days of
    a gap stay NULL, and only the first day of the series starts from ``zero``.
    ``ffill``: the last known value is carried through the gap, ``zero`` before the first point.
    """
    if fill not in ("lag1", "ffill"):
        raise ValueError(f"unknown fill={fill!r}")
    zero = F.lit(0.0) if zero is None else zero
    after_end = F.date_add(end, 1)

    def stretch(value: Column, days: Column, held: int) -> Column:
        if fill == "ffill":
            return F.array_repeat(value, days)
        copies = F.least(days, F.lit(held))
        return F.concat(F.array_repeat(value, copies), F.array_repeat(F.lit(None), days - copies))

    def series(known: Column) -> Column:
        def own_stretch(point: Column, index: Column) -> Column:
            following = F.coalesce(F.get(known, index + 1)["day"], after_end)
            return stretch(point["value"], F.date_diff(following, point["day"]), 2)

        lead_days = F.date_diff(F.coalesce(F.get(known, F.lit(0))["day"], after_end), start)
        return F.concat(stretch(zero, lead_days, 1), F.flatten(F.transform(known, own_stretch)))

    return _bind(F.sort_array(F.filter(points, lambda p: p["value"].isNotNull())), series)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once although ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def text_list(values: Column, missing: str = "-") -> Column:
    """An array as one comma-separated text (for flat reports and comparisons)."""
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",", missing)
