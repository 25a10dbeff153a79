"""Game schedule, stored-up-to dates and re-synchronisation."""

from pyspark.sql import DataFrame, functions as F

from courtledger import fixed_values as fv
from courtledger.functions.temporal import day_after, days_to_import
from courtledger.functions.text import slug_team
from courtledger.sources.manifest import replace_parts


def build_schedule(links: DataFrame, day, link, season) -> DataFrame:
    """Games named in links, once per day; days without games give no rows."""
    season = F.lit(season) if isinstance(season, int) else season
    return links.filter(F.col(link).contains(fv.SLUG_SEPARATOR)).select(
        slug_team(link, "away").alias("equipe_exterieure"),
        slug_team(link, "home").alias("equipe_domicile"),
        F.col(day).cast("date").alias("date_match"),
        season.alias("id_saison")).dropDuplicates()


def high_water_marks(games: DataFrame, schedule: DataFrame, ref, game_day="date_match",
                     schedule_day="date_match", season="id_saison") -> DataFrame:
    """One row: last stored days, the days to go on from, last season, days left to import.

    Both maxima come from one aggregate over the two tables laid end to end.
    """
    empty = lambda kind, name: F.lit(None).cast(kind).alias(name)
    seasons = schedule.schema[season].dataType
    both = games.select(F.col(game_day).cast("date").alias("g"), empty("date", "s"), empty(seasons, "n")) \
        .unionByName(schedule.select(empty("date", "g"), F.col(schedule_day).cast("date").alias("s"),
                                     F.col(season).alias("n")))
    marks = both.agg(F.max("g").alias("last_game"), F.max("s").alias("last_scheduled"),
                     F.max("n").alias("last_season"))
    return marks.withColumns({"next_game": day_after("last_game"),
                              "next_scheduled": day_after("last_scheduled")}) \
                .withColumn("days_to_import", days_to_import("next_scheduled", ref))


def sync_window(stored: DataFrame, fresh: DataFrame, day, first, last) -> DataFrame:
    """Replace the stored rows of a date range by the fresh ones; others stay as they are."""
    inside = F.col(day).between(F.to_date(F.lit(first)), F.to_date(F.lit(last)))
    return (stored.filter(~F.coalesce(inside, F.lit(False)))
                  .unionByName(fresh.filter(inside).dropDuplicates()))


def sync_stored_window(root, name, fresh: DataFrame, day, first, last, token) -> bool:
    """`sync_window` on a stored table in parts by day (see `sources.manifest`): only the parts of the range are written."""
    return replace_parts(fresh, root, name, day, str(first), str(last), token)
