"""First and top-n rows per key, and the oldest-first batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rn"


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """The first ``n`` rows of each key in ``order``; ``rank`` names a column to keep the position in.

    A row_number filter: Catalyst places a group limit in front of the shuffle, so each
    task sends at most ``n`` rows per key and a hot key never reaches one task whole.
    ``order`` must make the rows of a key unique, or ties are broken arbitrarily.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn(_RN, position).filter(F.col(_RN) <= n)
    return ranked.withColumnRenamed(_RN, rank) if rank else ranked.drop(_RN)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order``. NULL key parts count as equal."""
    return top_n_per_key(df, keys, order, 1)


def oldest_batch(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` oldest rows. Select only key and time columns first: the top-n ends in one task."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
