"""From the tables of game pages to clean player, game and team rows."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from courtledger import fixed_values as fv
from courtledger.functions.temporal import format_duration, is_dnp, is_injured, parse_minutes
from courtledger.functions.text import normalize_name, undouble_name
from courtledger.operators.reshape import (cast_measures, cells_to_columns, drop_last_char, edit_head,
                                           linear_score, null_where, period_map)

GAME = ["game_date", "game_no"]


def body_rows(tables: DataFrame, first, last) -> DataFrame:
    return tables.filter(~F.col("is_header") & F.col("table_idx").between(first, last))


def normalize_box_score(tables: DataFrame, keys=GAME) -> DataFrame:
    """Player rows of the first two tables of box-score pages, cleaned and scored.

    The order of the steps matters: the flags are read from the raw minute text, which is emptied
    afterwards for those who did not play. `rejected` names unreadable columns.
    """
    place = [*keys, "team_idx", "row_idx"]
    rows = body_rows(tables, 0, 1).filter(F.col("row_idx") < F.col("n_rows") - 1)
    rows = cells_to_columns(rows.withColumnRenamed("table_idx", "team_idx"), fv.PLAYER_COLUMNS, keep=place)
    rows = edit_head(rows, "nom", "row_idx", fv.STARTERS, drop_last_char)
    rows = rows.withColumns({"dnp": is_dnp("minute"), "blesse": is_injured("minute")})
    rows = null_where(rows, F.col("dnp"), keep=[*place, "nom", "dnp", "blesse"])
    rows = cast_measures(rows, keep=[*place, "nom", "minute", "dnp", "blesse"])
    unread = F.col("dnp").isNull() | (F.col("minute").isNotNull() & parse_minutes("minute").isNull())
    rows = rows.withColumn("rejected", F.when(
        unread, F.array_append("rejected", F.lit("minute"))).otherwise(F.col("rejected")))
    rows = rows.withColumns({"minute": parse_minutes("minute"), "nom": undouble_name("nom")})
    return rows.withColumns({
        "nom_simple": normalize_name("nom"),
        fv.SCORE_COLUMN: linear_score(fv.SCORE_GAINS, fv.SCORE_LOSSES, fv.SCORE_MADE_ATTEMPTED,
                                      when=~F.col("dnp")),
    })


def rejected_rows(players: DataFrame) -> DataFrame:
    """Rows with something unreadable, or of which nobody can tell whether they played."""
    return players.filter((F.size("rejected") > 0) | F.col("nom").isNull() | F.col("dnp").isNull())


def rejected_games(games: DataFrame, teams: DataFrame | None = None, keys=GAME) -> DataFrame:
    """Games with a reason: a team is missing, periods are too few or unreadable, team figures are unreadable."""
    counted = games.groupBy(*keys).agg(
        F.count(fv.TEAM_COLUMN).alias("n"),
        F.bool_or(F.col("periods").isNull() | F.exists(F.map_values("periods"), lambda v: v.isNull())).alias("bad"))
    reasons = [counted.filter("n <> 2").select(*keys, F.concat(F.col("n").cast("string"), F.lit(" teams")).alias("reason")),
               counted.filter("bad").select(*keys, F.lit("periods").alias("reason"))]
    if teams is not None and "rejected" in teams.columns:
        reasons.append(teams.filter(F.size("rejected") > 0).select(*keys, F.explode("rejected").alias("reason")).distinct())
    return reduce(DataFrame.unionByName, reasons)


def game_tables(tables: DataFrame, keys=GAME) -> DataFrame:
    """Two rows per game (0 away, 1 at home) with a map period -> points."""
    points = F.transform(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(0))),
                         lambda c: c.try_cast("int"))
    return body_rows(tables, 0, 0).select(
        *keys, F.col("row_idx").alias("team_idx"), F.get("cells", 0).alias(fv.TEAM_COLUMN),
        period_map(points).alias("periods"))


def team_tables(tables: DataFrame, keys=GAME) -> DataFrame:
    rows = body_rows(tables, 1, 1)
    named = cells_to_columns(rows, fv.TEAM_STAT_COLUMNS, keep=[*keys, "row_idx"])
    return cast_measures(named, keep=[*keys, "row_idx", fv.TEAM_COLUMN])


def player_facts(players: DataFrame, id_match="id_match") -> DataFrame:
    """Stored form of those who played, with the playing time as text."""
    return players.filter(~F.col("dnp")).select(
        *[format_duration(c).alias(c) if c == "minute" else F.col(c) for c in fv.PLAYER_FACT_COLUMNS],
        id_match)


def team_facts(teams: DataFrame, id_match="id_match") -> DataFrame:
    return teams.select(*fv.TEAM_STAT_COLUMNS, id_match)
