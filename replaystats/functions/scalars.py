"""Scalar expressions and predicates. All stay in the JVM; there is no Python UDF."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that the source database accepts as a boolean (every unambiguous
# prefix of the words, any case), and the blanks it trims.
TRUE_WORDS = ["t", "tr", "tru", "true", "y", "ye", "yes", "on", "1"]
FALSE_WORDS = ["f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0"]
BLANKS = " \t\n\r\f\v"

# Fixed value: the decoration characters around a skill number; blanks go as well.
SKILL_NOISE = "[]#~()"

# Category names and their player-count limits.
DUEL, FREE_FOR_ALL, SMALL_TEAM, LARGE_TEAM = "1v1", "FFA", "SmallTeam", "LargeTeam"
DUEL_PLAYERS = 2
FFA_MIN_TEAMS = 3
SMALL_TEAM_PLAYERS = (4, 10)
LARGE_TEAM_PLAYERS = (11, 16)


def json_text(col: Column | str, path: str) -> Column:
    """Text at a dotted path of a JSON string. For several fields parse once with ``from_json``."""
    return F.get_json_object(col, f"$.{path}")


def nullif_cast(col: Column | str, to: str, strict: bool = True) -> Column:
    """Blank text is NULL, everything else must be a valid ``to``: otherwise ANSI mode raises, or,
    not ``strict``, the value is NULL (see :func:`rejected`)."""
    text = F.nullif(_col(col), F.lit(""))
    return text.cast(to) if strict else text.try_cast(to)


def clean_skill(col: Column | str, strict: bool = True) -> Column:
    """``"[16.67]"`` and its variants to a float; blank to NULL."""
    return nullif_cast(skill_text(col), "float", strict)


def skill_text(col: Column | str) -> Column:
    return F.translate(_col(col), SKILL_NOISE + BLANKS, "")


def pg_bool(col: Column | str, strict: bool = True) -> Column:
    """Text to boolean with the source database's vocabulary; other text raises in ANSI mode, or is NULL."""
    word = F.lower(F.btrim(_col(col), F.lit(BLANKS)))
    known = F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))
    return known.otherwise(word.cast("boolean") if strict else F.lit(None).cast("boolean"))


def rejected(field: str, text: Column | str, value: Column, blank_is_null: bool = True) -> Column:
    """(field, value) of a text that is there and gave no value; NULL for all others."""
    given = _col(text).isNotNull() & (_col(text) != "") if blank_is_null else _col(text).isNotNull()
    return F.when(given & value.isNull(), F.struct(F.lit(field).alias("field"), _col(text).alias("value")))


def rejects(entries: Sequence[Column]) -> Column:
    """The rejected fields of a row as an array. Rows without any, nearly all, build none."""
    found = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return F.when(F.coalesce(*entries).isNotNull(), found).otherwise(F.array().cast("array<struct<field:string,value:string>>"))


def array_length(col: Column | str) -> Column:
    """Element count, NULL for a missing array."""
    return F.when(_col(col).isNotNull(), F.size(col))


def match_category(players: Column | str, teams: Column | str) -> Column:
    """Match category; the first rule that fits wins, and none leaves NULL."""
    players, teams = _col(players), _col(teams)
    return (
        F.when(players == DUEL_PLAYERS, DUEL)
        .when(teams >= FFA_MIN_TEAMS, FREE_FOR_ALL)
        .when(players.between(*SMALL_TEAM_PLAYERS), SMALL_TEAM)
        .when(players.between(*LARGE_TEAM_PLAYERS), LARGE_TEAM)
    )


def result_label(won: Column | str) -> Column:
    """An unknown result is shown as a loss."""
    return F.when(_col(won), "Win").otherwise("Loss")


def iso_timestamp(col: Column | str) -> Column:
    """ISO-8601 text with ``Z`` or an offset to a timestamp."""
    return F.to_timestamp(col)


def pg_round(col: Column | str, scale: int, single: bool = False) -> Column:
    """Round a floating number through its decimal text, half away from zero.

    The source database turns a real into a numeric through 6 significant digits and a
    double through 15, and rounds that. Rounding the binary value differs: 16.05 as a
    real lies below 16.05 and would give 16.0, not 16.1. NaN and infinity have no decimal and
    give NULL, so that one bad value does not stop a run.
    """
    digits = 6 if single else 15
    text = F.format_string(f"%.{digits - 1}e", _col(col).cast("double"))
    return F.when(_col(col).isNotNull(), F.round(text.try_cast("decimal(38,18)"), scale).cast(f"decimal(20,{scale})"))


def in_window(col: Column | str, start, end=None, closed: str = "both") -> Column:
    """Time predicate on a bare column, with literal bounds, so that it reaches the scan.

    ``closed``: ``both`` is [start, end]; ``left`` is [start, end); ``day`` is
    [start, end + 1 day), which takes in the whole last day. Without ``end`` only the
    lower bound applies.
    """
    col = _col(col)
    above = col >= time_bound(start)
    if end is None:
        return above
    if closed == "both":
        return above & (col <= time_bound(end))
    if closed == "left":
        return above & (col < time_bound(end))
    if closed == "day":
        return above & (col < time_bound(as_datetime(end) + timedelta(days=1)))
    raise ValueError(f"unknown closed={closed!r}")


def older_than(col: Column | str, as_of: datetime | str, hours: float) -> Column:
    """Strictly older than ``hours`` before ``as_of``."""
    return _col(col) < time_bound(as_datetime(as_of) - timedelta(hours=hours))


def as_datetime(value: datetime | date | str) -> datetime:
    """A clock argument as a naive UTC time."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def time_bound(value: datetime | date | str) -> Column:
    """A bound to compare a time column with.

    Plain text takes the type of the column it meets, with or without time zone, so the column
    itself is not cast and the comparison can be pushed to the scan.
    """
    return F.lit(as_datetime(value).isoformat(sep=" "))


def bucket_index(col: Column | str, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value, minus 1: -1 under the range, last bin open.

    A balanced tree of comparisons: log2(n) comparisons per row, inside generated code.
    """
    col = _col(col)

    def pick(lo: int, hi: int) -> Column:
        # Known here: exactly lo..hi edges are at or below the value.
        if lo == hi:
            return F.lit(lo - 1)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(edges[mid]), pick(lo, mid)).otherwise(pick(mid + 1, hi))

    return F.when(col.isNotNull(), pick(0, len(edges)))


def ts_lit(value: datetime | date | str) -> Column:
    """A timestamp literal."""
    return time_bound(value).cast("timestamp")


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
