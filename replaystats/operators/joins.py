"""Joins with the reference semantics, laid out so that the large side moves as little as possible."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaystats.operators.keyed import first_per_key
from replaystats.session import fits_broadcast


def not_in(df: DataFrame, large: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``large``. Rows with a NULL key part match nothing and stay.

    An anti join can broadcast only its right side, and would shuffle a large table for every small
    batch. So where the keys of ``df`` are few enough to broadcast, the large side is first cut down by
    a semi join to those that occur, and stays where it is. Beyond that a plain anti join shuffles each
    side once. The rows with a NULL key part skip the joins, so they cannot pile up in one task.
    """
    keys = list(keys)
    has_key = all_present(keys)
    known = cut_down(large, df, keys)
    return df.filter(has_key).join(known, keys, "left_anti").select(*df.columns).unionByName(df.filter(~has_key))


def cut_down(large: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``large``, without those that ``ids`` has not, where that takes no shuffle."""
    known, wanted = large.select(*keys), ids.select(*keys)
    return known.join(F.broadcast(wanted), list(keys), "left_semi") if fits_broadcast(wanted) else known


def only_in(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``ids`` (semi join on distinct keys)."""
    keys = list(keys)
    return df.join(ids.select(*keys).distinct(), keys, "left_semi").select(*df.columns)


def prefer_left_union(
    left: DataFrame,
    right: DataFrame,
    key: str,
    cols: Sequence[str],
    fieldwise: bool = False,
    left_keys: DataFrame | None = None,
) -> DataFrame:
    """All rows of both sides, each unique by ``key``; where both have a key the left one wins.

    The default takes left rows whole and adds right rows with unknown keys, so filters on the
    result reach both scans. ``fieldwise`` fills NULL fields of a left row from the right row by
    a full outer join; needed only where left fields can be NULL. ``left_keys`` holds the keys of
    the whole left table where ``left`` itself was already cut down to a window.
    """
    cols = [c for c in cols if c != key]
    if not fieldwise:
        known = left if left_keys is None else left_keys
        return left.select(key, *cols).unionByName(not_in(right.select(key, *cols), known, [key]))
    lhs, rhs = left.alias("lhs"), right.alias("rhs")
    joined = lhs.join(rhs, F.col(f"lhs.{key}") == F.col(f"rhs.{key}"), "full_outer")
    return joined.select(*[F.coalesce(F.col(f"lhs.{c}"), F.col(f"rhs.{c}")).alias(c) for c in [key, *cols]])


def filter_new(
    listing: DataFrame, seen: DataFrame, key: str, order: Sequence[Column], force: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Listed items not seen before, and a one-row frame with the number skipped.

    Items without an id are dropped and not counted. Repeats inside the batch count as seen;
    the first in ``order`` stays. ``force`` admits seen ids and repeats.
    """
    listed = listing.filter(F.col(key).isNotNull())
    if force:
        new = listed
    else:
        new = not_in(first_per_key(listed, [key], order), seen, [key])
    signed = listed.select(F.lit(1).alias("n")).unionByName(new.select(F.lit(-1).alias("n")))
    return new, signed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("skipped"))


def join_default(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """Left join; the named right columns get their default where there is no match."""
    joined = left.join(right, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def densify(
    df: DataFrame, keys: Sequence[str], axis: str, values: Column, value: str, default: object = None
) -> DataFrame:
    """One row per key and axis position; positions without a row get ``default``.

    ``values`` is the array of axis positions. ``df`` must be unique by (keys, axis), so a key's
    rows are no more than the axis is long. They are gathered per key and then expanded in
    place: there is no grid join, and the expanded rows are never shuffled.
    """
    in_axis = F.array_contains(values, F.col(axis))
    entry = F.when(in_axis, F.struct(F.col(axis).alias("key"), F.col(value).alias("value")))
    gathered = df.groupBy(*keys).agg(F.map_from_entries(F.collect_list(entry)).alias("_known"))
    grid = gathered.select(*keys, "_known", F.explode(values).alias(axis))
    filled = F.coalesce(F.try_element_at("_known", F.col(axis)), F.lit(default))
    return grid.select(*keys, axis, filled.alias(value))


def all_present(keys: Sequence[str]) -> Column:
    """No part of the key is NULL."""
    present = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        present = present & F.col(k).isNotNull()
    return present
