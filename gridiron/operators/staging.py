"""Staging models: explicit column lists and null filters over the raw tables.

A model is one declaration, usable as a lazy DataFrame and as a catalog view.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from gridiron.schemas import LEAGUE_ROSTERS, PLAYS, ROSTERS


@dataclass(frozen=True)
class StagingModel:
    source: str
    columns: tuple[str, ...]
    where: tuple[str, ...] = ()

    def build(self, raw: DataFrame) -> DataFrame:
        for condition in self.where:
            raw = raw.where(condition)
        return raw.selectExpr(*self.columns)

    def view_sql(self) -> str:
        text = f"SELECT {', '.join(self.columns)} FROM {self.source}"
        return f"{text} WHERE {' AND '.join(self.where)}" if self.where else text

    def condition(self) -> str:
        return " AND ".join(self.where) or "true"

    def without_no_play(self) -> StagingModel:
        """The same model, also dropping plays of the type "no_play"."""
        return replace(self, where=(*self.where, "play_type <> 'no_play'"))


# The text "no_play" is a known play type and stays: the filters test for null only.
STG_PBP = StagingModel(
    source="raw.pbp",
    columns=(
        "season",
        "game_id",
        "week",
        "posteam AS possession_team",
        "defteam AS defense_team",
        "play_type",
        "yards_gained",
        "epa",
    ),
    where=("play_type IS NOT NULL", "posteam IS NOT NULL"),
)

_TEAM_LEVEL_ONLY = ("defteam", "play_type", "yards_gained", "epa")

STG_PBP_PLAYER_STATS = StagingModel(
    source="raw.pbp",
    columns=("season", "week", "game_id", "posteam AS team")
    + tuple(
        name
        for name in PLAYS.fieldNames()
        if name not in ("season", "week", "game_id", "posteam") + _TEAM_LEVEL_ONLY
    ),
    where=("play_type IS NOT NULL",),
)

STG_ROSTERS = StagingModel(
    source="raw.rosters",
    columns=tuple(ROSTERS.fieldNames()),
)

STG_LEAGUE_ROSTERS = StagingModel(
    source="raw.sleeper_rosters",
    columns=tuple(LEAGUE_ROSTERS.fieldNames()),
)

#: View name in the staging database -> model.
STAGING_MODELS = {
    "stg_pbp": STG_PBP,
    "stg_pbp_player_stats": STG_PBP_PLAYER_STATS,
    "stg_rosters": STG_ROSTERS,
    "stg_sleeper_rosters": STG_LEAGUE_ROSTERS,
}


def stg_pbp(plays: DataFrame, exclude_no_play: bool = False) -> DataFrame:
    """Plays of known type and possession; ``exclude_no_play`` also drops the type "no_play"."""
    return (STG_PBP.without_no_play() if exclude_no_play else STG_PBP).build(plays)


def stg_pbp_player_stats(plays: DataFrame, exclude_no_play: bool = False) -> DataFrame:
    """Plays of known type with all player-attributed columns; a null team stays."""
    return (STG_PBP_PLAYER_STATS.without_no_play() if exclude_no_play else STG_PBP_PLAYER_STATS).build(plays)


def stg_rosters(rosters: DataFrame) -> DataFrame:
    return STG_ROSTERS.build(rosters)


def stg_league_rosters(league: DataFrame) -> DataFrame:
    return STG_LEAGUE_ROSTERS.build(league)
