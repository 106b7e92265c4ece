"""Insert-ignore, upsert and age-based move as pure functions of target and batch.

They return rows, not side effects (staged keys apart). Inserts return only the new rows, so that a large
target is appended to and never rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replaystats.functions.scalars import older_than
from replaystats.operators.joins import all_present, cut_down, only_in
from replaystats.operators.keyed import first_per_key, oldest_batch
from replaystats.session import fits_broadcast, stage

_STORED, _OWN = "_stored", "_own"

# Fixed value: age of a move from the cache to the archive.
MOVE_AFTER_HOURS = 24


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """The rows of ``batch`` that an insert with "on conflict do nothing" would add.

    Of batch rows with the same key the first in ``order`` stays. As in a unique index, a key
    with a NULL part conflicts with nothing, so those rows all pass, around the joins.

    A batch small enough to broadcast leaves the target where it is. Beyond that the keys of the
    target join the batch in one shuffle, as rows that come before all others of their key: a batch
    row is new if it is the first of its key. Each task sends one row a key, so no key is hot.
    """
    keys = list(keys)
    has_key = all_present(keys)
    order = order or [F.col(c).asc_nulls_last() for c in batch.columns if c not in keys] or [F.lit(0)]
    keyed = batch.filter(has_key)
    if fits_broadcast(keyed):
        known = cut_down(target, keyed, keys)
        new = first_per_key(keyed, keys, order).join(known, keys, "left_anti").select(*batch.columns)
    else:
        stored = target.select(*keys).filter(has_key).withColumn(_STORED, F.lit(True))
        both = keyed.withColumn(_STORED, F.lit(False)).unionByName(stored, allowMissingColumns=True)
        first = first_per_key(both, keys, [F.desc(_STORED), *order])
        new = first.filter(~F.col(_STORED)).select(*batch.columns)
    return new.unionByName(batch.filter(~has_key))


def insert_match_players(target: DataFrame, batch: DataFrame, order: Sequence[Column]) -> DataFrame:
    """New player rows. Known users and unknown users have different unique keys.

    A known user already stored for a match is not added again under any player id; inside a
    new match several player ids of one user are all kept.
    """
    known = batch.filter(F.col("user_id").isNotNull())
    unknown = batch.filter(F.col("user_id").isNull())
    stored_unknown = target.filter(F.col("user_id").isNull())
    in_match = F.col("replay_id").isNotNull()
    # Repeats in the batch first, a row a key from each task, so that no key is hot in the join. Rows
    # without a player id repeat nothing: a number makes each its own key. (A union would be joined,
    # and so shuffled, branch by branch.)
    own = F.when(F.col("player_id").isNull(), F.monotonically_increasing_id())
    unique = first_per_key(known.filter(in_match).withColumn(_OWN, own), ["replay_id", "user_id", "player_id", _OWN], order)
    # A row whose (user, match) is stored is dropped here, so a full (match, user, player)
    # conflict with the target cannot be left over.
    stored = cut_down(target.filter(F.col("user_id").isNotNull()), known, ["user_id", "replay_id"])
    fresh = unique.join(stored, ["user_id", "replay_id"], "left_anti").select(*batch.columns)
    fresh = fresh.unionByName(known.filter(~in_match))
    return fresh.unionByName(insert_ignore(stored_unknown, unknown, ["replay_id", "player_id"], order))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """The whole target after an upsert that changes only ``update_cols`` of stored rows.

    Both sides are unique by ``keys``. One full outer join: each side is shuffled once.
    """
    old = target.withColumn("_stored", F.lit(True)).alias("old")
    new = batch.withColumn("_given", F.lit(True)).alias("new")
    on = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys]
    joined = old.join(new, on, "full_outer")

    def pick(name: str) -> Column:
        stored, given = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in update_cols:
            return F.when(F.col("_given"), given).otherwise(stored)
        return F.when(F.col("_stored"), stored).otherwise(given)

    return joined.select(*[pick(c).alias(c) for c in target.columns])


def age_out(
    cache: DataFrame,
    archive: DataFrame,
    as_of: datetime | str,
    hours: float = MOVE_AFTER_HOURS,
    limit: int | None = None,
    key: str = "replay_id",
    time: str = "start_time",
) -> tuple[DataFrame, DataFrame]:
    """Move aged cache rows to the archive: (remaining cache, rows to append to the archive).

    Everything old enough moves. A key moves with all its copies as soon as one of them is old
    enough; rows without a key stay. Only the keys meet: documents are told apart where they lie, but for
    the copies of keys that stand on both sides of the limit, whose keys are staged and looked up. With
    ``limit`` only the so many oldest move: keys and times are sorted for that cut and the documents
    picked up by a semi join. Rows whose key the archive already has leave the cache all the same.
    """
    old = F.coalesce(older_than(time, as_of, hours) & F.col(key).isNotNull(), F.lit(False))
    if limit is None:
        aged, young = cache.filter(old), cache.filter(~old)
        both = stage(young.select(key).join(aged.select(key), [key], "left_semi").distinct(), "split-keys")
        moved = aged.unionByName(young.join(both, [key], "left_semi").select(*cache.columns))
        remaining = young.join(both, [key], "left_anti").select(*cache.columns)
    else:
        aged = oldest_batch(cache.select(key, time).filter(old), [time, key], limit)
        moved = only_in(cache, aged, [key])
        remaining = cache.join(aged.select(key).distinct(), [key], "left_anti").select(*cache.columns)
    return remaining, insert_ignore(archive, moved, [key], [F.col(time).asc_nulls_last()])
