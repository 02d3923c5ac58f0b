"""The weekly run: land the sources, build marts, check them, publish all of it at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridiron import schemas
from gridiron.functions.scoring import DEFAULT_SCORING
from gridiron.operators import boxscore, players, staging, teams
from gridiron.plans import checks
from gridiron.plans import queries as q
from gridiron.sources import league, seasons, tables


@dataclass(frozen=True)
class PipelineConfig:
    """Where the landed files are and whose roster is "mine".

    ``only_seasons`` refreshes just the given seasons of the play and roster
    tables and of the marts built from them, leaving other partitions alone.
    ``grain`` "listed" keeps one row per (team, name) pairing of a player's
    week, "player" one row per player and week.  ``exclude_no_play`` drops plays
    of the type "no_play", which the filters otherwise keep.
    """

    plays_root: str
    rosters_root: str
    league_rosters: str
    league_users: str
    my_user_id: str
    seasons: Sequence[int] | None = None
    only_seasons: bool = False
    scoring: Mapping[str, float] = field(default_factory=lambda: dict(DEFAULT_SCORING))
    grain: str = "listed"
    exclude_no_play: bool = False


def together(spark: SparkSession, jobs: Sequence[Callable[[], None]]) -> None:
    """Run independent jobs side by side, so that small ones fill gaps of large ones."""
    run = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max_workers=max(1, min(len(jobs), 8))) as pool:
        for done in [pool.submit(run(job)) for job in jobs]:
            done.result()


def _requested(config: PipelineConfig) -> list[int] | None:
    """The seasons to refresh; None for all there are."""
    return list(config.seasons or ()) if config.only_seasons else None


def _land_seasons(release: tables.Release, config: PipelineConfig, root: str, schema, name: str, skipped: list[int]) -> None:
    """Lands every season by a job of its own, so that one which fails while it is read is left out like one that is missing."""
    frames = seasons.season_frames(release.spark, root, config.seasons, skipped)
    whole = seasons.union_seasons(frames.values(), schema).schema  # the columns and types of all seasons together
    release.begin_seasons(name, whole, _requested(config))

    def land_season(season: int, frame: DataFrame) -> None:
        typed = seasons.cast_declared(frame, schema)
        columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in whole if f.name in typed.columns]
        try:
            release.write_season(typed.select(*columns), name, season)
        except seasons.UNREADABLE as error:
            seasons.skip(season, root, error, skipped)

    together(release.spark, [lambda s=s, f=f: land_season(s, f) for s, f in frames.items()])
    if set(frames) <= set(skipped):
        raise seasons.NoSeasonError(f"no season of {root} could be read")


def land(config: PipelineConfig, release: tables.Release) -> dict[str, list[int]]:
    """Writes the raw tables from the landed files; returns the seasons that could not be read, by table.

    A refresh of given seasons keeps the old rows of one that could not be read.
    """
    spark = release.spark
    skipped: dict[str, list[int]] = {"pbp": [], "rosters": []}

    def land_league() -> None:
        flat = league.flatten_league(
            league.read_league_rosters(spark, config.league_rosters),
            league.read_league_users(spark, config.league_users),
            config.my_user_id,
        )
        release.write(flat, f"{tables.RAW}.sleeper_rosters")

    together(
        spark,
        [
            lambda: _land_seasons(release, config, config.plays_root, schemas.PLAYS, f"{tables.RAW}.pbp", skipped["pbp"]),
            lambda: _land_seasons(release, config, config.rosters_root, schemas.ROSTERS, f"{tables.RAW}.rosters", skipped["rosters"]),
            land_league,
        ],
    )
    return skipped


def _staging_models(exclude_no_play: bool) -> dict[str, staging.StagingModel]:
    return {
        name: model.without_no_play() if exclude_no_play and "play_type IS NOT NULL" in model.where else model
        for name, model in staging.STAGING_MODELS.items()
    }


def staging_views(exclude_no_play: bool = False) -> dict[str, str]:
    """View name -> query."""
    return {f"{tables.STAGING}.{name}": model.view_sql() for name, model in _staging_models(exclude_no_play).items()}


def build_marts(config: PipelineConfig, release: tables.Release) -> None:
    """Writes the marts from this release's raw tables."""
    models, requested = _staging_models(config.exclude_no_play), _requested(config)

    def staged(name: str) -> DataFrame:
        df = models[name].build(release.table(models[name].source))
        if requested and "season" in df.columns:
            df = df.where(df.season.isin(requested))
        return df

    def write(name: str, df: DataFrame) -> None:
        release.write(tables.by_partition(df, "season"), f"{tables.MARTS}.{name}", "season", requested)

    def write_each(name: str, df: DataFrame, source: str, requested: list[int] | None = None) -> None:
        """A mart whose rows of a season come from those of ``source``: a job a season, which need not deal or sort its rows."""
        mart = f"{tables.MARTS}.{name}"
        found = [s for s in release.seasons(source) if requested is None or s in requested]
        release.begin_seasons(mart, df.schema, requested)
        together(release.spark, [lambda s=s: release.write_season(df.where(F.col("season") == s), mart, s) for s in found])
        release.end_seasons(mart, found, requested)

    def mart(name: str) -> DataFrame:
        return release.table(f"{tables.MARTS}.{name}")

    box = {"listed": boxscore.player_game_stats, "player": boxscore.player_game_stats_by_player}[config.grain]

    def build_game_stats() -> None:
        write("fct_player_game_stats", box(staged("stg_pbp_player_stats"), config.scoring))

    def build_team_week() -> None:
        write("fct_team_week_epa", teams.team_week_epa(staged("stg_pbp")))

    def build_player_week() -> None:
        write_each("fct_player_week", players.player_week(staged("stg_rosters")), models["stg_rosters"].source, requested)

    def build_roster_status() -> None:
        # Ownership is a snapshot: a new one applies to all weeks, so this mart is always built in full.
        status = players.player_roster_status(mart("fct_player_week"), staged("stg_sleeper_rosters"))
        write_each("fct_player_roster_status", status, f"{tables.MARTS}.fct_player_week")

    def build_base() -> None:
        # Owner and position are a player's, not a week's, so the base too is always built in full.
        release.write(q.first_attributes(mart("fct_player_roster_status")), f"{tables.MARTS}.player_attributes")
        base = q.with_attributes(mart("fct_player_game_stats"), mart("player_attributes"))
        # what boards and tiles filter by
        release.write(tables.clustered(base, "season", "position", "player_name"), f"{tables.MARTS}.player_week_base", "season")

    together(release.spark, [build_game_stats, build_team_week, build_player_week])
    build_roster_status()
    build_base()


def check(release: tables.Release, exclude_no_play: bool = False) -> DataFrame:
    """Report over all checked views and marts of the release; views over one raw table are counted in one read of it.

    The checked columns are named in the raw tables as in the views.
    """
    models = _staging_models(exclude_no_play)
    parts: dict[str, dict[str, str]] = {}
    for name in checks.NOT_NULL:
        source = models[name].source if name in models else f"{tables.MARTS}.{name}"
        parts.setdefault(source, {})[name] = models[name].condition() if name in models else "true"
    return checks.quality_report([(release.table(source), of) for source, of in parts.items()])


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """Land, build, check, publish; returns the report.

    If a check of severity error is broken it raises, and the tables stay those of the
    run before; else all tables become this run's at once.  A season that could not be
    read is a row of severity warn in the report.
    """
    release = tables.Release(spark)
    skipped = land(config, release)
    build_marts(config, release)
    rows = check(release, config.exclude_no_play)
    unread = [
        (f"{tables.RAW}.{name}", f"season={season}", checks.WARN, 1) for name, of in skipped.items() for season in sorted(of)
    ]
    report = spark.createDataFrame([tuple(r) for r in rows.collect()] + unread, rows.schema)  # a row per check and season
    checks.enforce(report)
    release.publish(staging_views(config.exclude_no_play))
    return report
