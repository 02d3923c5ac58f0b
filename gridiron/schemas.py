"""Declared schemas of the raw inputs.

Flags and yardage are nullable doubles: the feeds deliver them as floats in
which a missing value is NaN or null.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DBL, STR, BOOL = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


def _schema(**groups: tuple[T.DataType, list[str]]) -> T.StructType:
    """Schema from groups of column names sharing one type."""
    return T.StructType([T.StructField(name, dtype) for dtype, names in groups.values() for name in names])


#: The names and types of the columns.  One row per play.
PLAYS = _schema(
    when=(INT, ["season", "week"]),
    play=(STR, ["game_id", "posteam", "defteam", "play_type"]),
    outcome=(DBL, ["yards_gained", "epa"]),
    passer=(STR, ["passer_player_id", "passer_player_name"]),
    passing=(DBL, ["pass_attempt", "complete_pass", "passing_yards", "pass_touchdown", "interception"]),
    rusher=(STR, ["rusher_player_id", "rusher_player_name"]),
    rushing=(DBL, ["rush_attempt", "rushing_yards", "rush_touchdown"]),
    receiver=(STR, ["receiver_player_id", "receiver_player_name"]),
    receiving=(DBL, ["receiving_yards", "air_yards", "yards_after_catch"]),
    conversion=(DBL, ["two_point_attempt"]),
    conversion_result=(STR, ["two_point_conv_result"]),
    fumbler=(STR, ["fumbled_1_player_id"]),
    fumble=(DBL, ["fumble", "fumble_lost"]),
    recovery=(STR, ["fumble_recovery_1_player_id", "fumble_recovery_1_team"]),
    kicker=(STR, ["kicker_player_id", "kicker_player_name"]),
    goal=(DBL, ["field_goal_attempt"]),
    goal_result=(STR, ["field_goal_result"]),
    kick=(DBL, ["kick_distance", "extra_point_attempt"]),
    point_result=(STR, ["extra_point_result"]),
    scored=(DBL, ["touchdown", "return_touchdown"]),
)

#: One row per player and week.
ROSTERS = _schema(
    when=(INT, ["season", "week"]),
    player=(STR, ["team", "player_id", "sleeper_id", "player_name", "position"]),
    numbers=(DBL, ["years_exp", "draft_number", "age"]),
    state=(STR, ["status"]),
)

#: League snapshot, one row per roster as the service delivers it.
LEAGUE_ROSTERS_JSON = T.StructType(
    [
        T.StructField("roster_id", INT),
        T.StructField("owner_id", STR),
        T.StructField("players", T.ArrayType(STR)),
        T.StructField("settings", T.StructType([T.StructField("wins", INT), T.StructField("losses", INT)])),
    ]
)

#: The name is a variant, because a missing key and a null value differ.
LEAGUE_USER = T.StructType([T.StructField("user_id", STR), T.StructField("display_name", T.VariantType())])

#: League snapshot after flattening, one row per (roster, player).
LEAGUE_ROSTERS = _schema(
    roster=(INT, ["roster_id"]),
    owner=(STR, ["owner_id", "owner_name"]),
    mine=(BOOL, ["is_my_roster"]),
    player=(STR, ["sleeper_id"]),
    record=(INT, ["wins", "losses"]),
)
