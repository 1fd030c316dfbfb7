"""Declared schemas and name maps. Nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import types as T

# All whole numbers are 64 bits wide: a counter or key of a large table must not overflow.
_int = T.LongType()
_str = T.StringType()


def _struct(spec: str, kind: T.DataType = _int) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name in spec.split()])


# --- fixed values: league standings snapshots ------------------------------
# Bound to the CSV by position: the files repeat W D L GF GA for home and away.
STANDINGS_RAW = T.StructType(
    [
        T.StructField("Pos", _int),
        T.StructField("Team", _str),
        T.StructField("P", _int),
        T.StructField("W", _int),
        T.StructField("D", _int),
        T.StructField("L", _int),
        T.StructField("GF", _int),
        T.StructField("GA", _int),
        T.StructField("W.1", _int),
        T.StructField("D.1", _int),
        T.StructField("L.1", _int),
        T.StructField("GF.1", _int),
        T.StructField("GA.1", _int),
        T.StructField("GD", _int),
        T.StructField("Pts", _int),
        T.StructField("match_date", T.DateType()),
    ]
)
STANDINGS_DATE_FORMAT = "yyyy-MMM-dd"

STANDINGS_RENAMES = {
    "Pos": "ranking",
    "Team": "team",
    "P": "matches_played",
    "W": "win_home",
    "D": "draw_home",
    "L": "loss_home",
    "GF": "goals_for_home",
    "GA": "goals_against_home",
    "W.1": "win_away",
    "D.1": "draw_away",
    "L.1": "loss_away",
    "GF.1": "goals_for_away",
    "GA.1": "goals_against_away",
    "GD": "goal_difference",
    "Pts": "points",
    "match_date": "snapshot_date",
}

STANDINGS_TOTALS = {
    "wins": ("win_home", "win_away"),
    "draws": ("draw_home", "draw_away"),
    "losses": ("loss_home", "loss_away"),
    "goals_for": ("goals_for_home", "goals_for_away"),
    "goals_against": ("goals_against_home", "goals_against_away"),
}

TABLE_COLUMNS = [
    "ranking",
    "team",
    "matches_played",
    "wins",
    "draws",
    "losses",
    "goals_for",
    "goals_against",
    "goal_difference",
    "points",
]
SILVER_COLUMNS = [*TABLE_COLUMNS, "entity_id", "snapshot_date"]

# Raw files carry three blank separator columns between the blocks.
RAW_FILE_COLUMNS = 19

# --- fixed values: team season summary -------------------------------------
TEAM_COUNTERS = ["played", "wins", "draws", "loses"]
TEAM_SIDES = ["home", "away", "total"]
TEAM_SUMMARY = T.StructType(
    [T.StructField(f"{c}.{s}", _int) for c in TEAM_COUNTERS for s in TEAM_SIDES]
    + [T.StructField("match_date", T.DateType())]
)

# --- fixed values: players (goal scorers and assists) -----------------------
# The spellings "committed" (fouls) and "commited" (penalty) are those of the data.
PLAYER_STATISTICS = T.StructType(
    [
        T.StructField("team", T.StructType([T.StructField("id", _int), *_struct("name logo", _str)])),
        T.StructField(
            "league",
            T.StructType(
                [
                    T.StructField("id", _int),
                    *_struct("name country logo flag", _str),
                    T.StructField("season", _int),
                ]
            ),
        ),
        T.StructField(
            "games",
            T.StructType(
                [
                    *_struct("appearences lineups minutes number"),
                    *_struct("position rating", _str),
                    T.StructField("captain", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("substitutes", _struct("in out bench")),
        T.StructField("shots", _struct("total on")),
        T.StructField("goals", _struct("total conceded assists saves")),
        T.StructField("passes", _struct("total key accuracy")),
        T.StructField("tackles", _struct("total blocks interceptions")),
        T.StructField("duels", _struct("total won")),
        T.StructField("dribbles", _struct("attempts success past")),
        T.StructField("fouls", _struct("drawn committed")),
        T.StructField("cards", _struct("yellow yellowred red")),
        T.StructField("penalty", _struct("won commited scored missed saved")),
    ]
)

PLAYER_PROFILE = T.StructType(
    [
        T.StructField("id", _int),
        *_struct("name firstname lastname", _str),
        T.StructField("age", _int),
        T.StructField("birth", _struct("date place country", _str)),
        *_struct("nationality height weight", _str),
        T.StructField("injured", T.BooleanType()),
        T.StructField("photo", _str),
    ]
)

# Collected player files hold the profile with the statistics struct named "0".
PLAYERS = T.StructType([*PLAYER_PROFILE, T.StructField("0", PLAYER_STATISTICS)])

PLAYERS_PAYLOAD = T.StructType(
    [
        T.StructField(
            "response",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("player", PLAYER_PROFILE),
                        T.StructField("statistics", T.ArrayType(PLAYER_STATISTICS)),
                    ]
                )
            ),
        )
    ]
)

TEAM_PAYLOAD = T.StructType(
    [
        T.StructField(
            "response",
            T.StructType(
                [
                    T.StructField(
                        "fixtures",
                        T.StructType(
                            [T.StructField(c, _struct(" ".join(TEAM_SIDES))) for c in TEAM_COUNTERS]
                        ),
                    )
                ]
            ),
        )
    ]
)

# Both spellings occur in the data; the first is the one of the schema.
SPELLINGS = {"fouls.committed": ["fouls.commited"], "penalty.commited": ["penalty.committed"]}

# --- fixed values: run history and audit ------------------------------------
AUDIT_METRICS = ["numFiles", "numOutputRows", "numOutputBytes", "numRejectedRows"]

HISTORY = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("userId", _str),
        T.StructField("userName", _str),
        T.StructField("operation", _str),
        T.StructField("operationMetrics", T.MapType(_str, _str)),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("operation", _str),
        T.StructField("version", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("userId", _str),
        T.StructField("userName", _str),
        *[T.StructField(name, T.LongType()) for name in AUDIT_METRICS],
    ]
)
