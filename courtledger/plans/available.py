"""Who can be picked on a day."""

from pyspark.sql import DataFrame, functions as F

from courtledger.operators.matching import drop_members
from courtledger.operators.skew import own_shuffle


def available(schedule: DataFrame, contracts: DataFrame, players: DataFrame, injuries: DataFrame,
              picks: DataFrame, day, positions: DataFrame | None = None) -> DataFrame:
    """Players under contract with a team that plays that day, neither injured nor picked before."""
    day = F.to_date(F.lit(day))
    games = schedule.filter(F.col("date_match") == day)
    teams = games.select(F.explode(F.array("equipe_domicile", "equipe_exterieure")).alias("id_equipe"),
                         "equipe_domicile", "equipe_exterieure")
    opponent = F.when(F.col("id_equipe") == F.col("equipe_domicile"),
                      F.col("equipe_exterieure")).otherwise(F.col("equipe_domicile"))
    playing = own_shuffle(teams.select("id_equipe", opponent.alias("adversaire")).distinct())
    signed = contracts.filter(F.col("date_fin_contrat").isNull()).select("id_joueur", "id_equipe")
    hurt = injuries.filter(F.col("date_guerison").isNull() & (F.col("date_blessure") <= day))
    free = drop_members(drop_members(signed.join(playing, "id_equipe"), hurt, ["id_joueur"]),
                        picks, ["id_joueur"])
    named = free.join(players, "id_joueur")
    if positions is not None:
        named = named.join(positions, "id_position_terrain", "left")
    return named
