"""Ratios and the adjusted rating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the rating: hard-lobby threshold, rating step and smallest share of hard games.
HARD_LOBBY_SKILL = 28.0
K_FACTOR = 10.0
MIN_HARD_SHARE = 0.3


def safe_rate(num: Column, den: Column, scale: int, pct: bool = False) -> Column:
    """``num / den`` as a rounded decimal (times 100 for ``pct``); 0 where ``den`` is 0."""
    num = num.cast("decimal(20,0)") * (100 if pct else 1)
    den = F.nullif(den.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.coalesce(F.round(num / den, scale), F.lit(0)).cast(f"decimal(12,{scale})")


def plain_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as a double; 0 where ``den`` is 0."""
    return F.coalesce(num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0)), F.lit(0.0))


def adjusted_rating(
    skill: Column,
    hard_wins: Column,
    hard_games: Column,
    easy_wins: Column,
    easy_games: Column,
    games: Column,
    k: float = K_FACTOR,
    min_share: float = MIN_HARD_SHARE,
) -> Column:
    """Skill corrected for results and for how hard the lobbies were.

    Too few hard games cost half a step. Otherwise the win share over rated games moves
    the skill by up to half a step, and doing better in hard than in easy lobbies adds a
    quarter of the lead. The share is compared as double against the single-precision
    threshold, so exactly 30 % counts as too few.
    """
    skill = F.coalesce(skill.cast("double"), F.lit(0.0))
    hard_rate, easy_rate = plain_ratio(hard_wins, hard_games), plain_ratio(easy_wins, easy_games)
    threshold = F.lit(min_share).cast("float").cast("double")
    form = (plain_ratio(hard_wins + easy_wins, games) - F.lit(0.5)) * F.lit(k)
    lead = F.greatest(hard_rate - easy_rate, F.lit(0.0)) * F.lit(k * 0.25)
    return (
        F.when(games == 0, skill)
        .when(plain_ratio(hard_games, games) < threshold, skill - F.lit(k * 0.5))
        .otherwise(skill + form + lead)
    )
