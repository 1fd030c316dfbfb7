from __future__ import annotations

from pyspark.sql import Column, functions as F


def league_points(wins: Column, draws: Column) -> Column:
    """Three points for a win, one for a draw."""
    return 3 * wins + draws


def home_away_totals(totals: dict[str, tuple[str, str]]) -> dict[str, Column]:
    """Sum columns by name; a total is NULL when either side is NULL."""
    return {name: F.col(home) + F.col(away) for name, (home, away) in totals.items()}


def total_contributions(*counters: Column) -> Column:
    """Sum of counters in which a missing counter means none."""
    total = F.lit(0)
    for counter in counters:
        total = total + F.coalesce(counter, F.lit(0))
    return total
