"""Picked players: incremental load of a paged history."""

from pyspark.sql import DataFrame, functions as F

from courtledger.functions.text import normalize_name
from courtledger.operators.matching import exclude_marginal
from courtledger.operators.reshape import cells_to_columns, drop_footer


def pick_rows(tables: DataFrame, page="page_no", names=("Date", "Joueur")) -> DataFrame:
    """Rows of the first table of every page in page order, without the last row of the last page."""
    rows = tables.filter(~F.col("is_header") & (F.col("table_idx") == 0))
    rows = cells_to_columns(rows, names, keep=[page, "row_idx"])
    return drop_footer(rows, group=[], order=[page, "row_idx"]).select(*names)


def new_picks(picks: DataFrame, players: DataFrame, stored: DataFrame, season, day="Date",
              name="Joueur", key="id_joueur", known_name="nom_simple", stored_day="date_choix") -> DataFrame:
    """Picks of known players whose date and player are not both stored already."""
    named = picks.select(F.col(day).try_cast("date").alias(stored_day), normalize_name(name).alias(known_name))
    known = named.join(players.select(key, known_name), known_name)
    fresh = exclude_marginal(known, stored, {stored_day: stored_day, key: key})
    return fresh.select(stored_day, key, F.lit(season).alias("saison"))
