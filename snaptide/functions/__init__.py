"""Column expressions."""

from .keys import constant_key, entity_key
from .measures import home_away_totals, league_points, total_contributions
from .names import named
from .text import blank_to_null, collapse_separators, strip_tags

__all__ = [
    "blank_to_null",
    "collapse_separators",
    "constant_key",
    "entity_key",
    "home_away_totals",
    "league_points",
    "named",
    "strip_tags",
    "total_contributions",
]
