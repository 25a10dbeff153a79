"""Declared schemas of the stored tables."""

from pyspark.sql import types as T

from courtledger import fixed_values as fv

L, I, S, D, B, DT = (T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(),
                     T.BooleanType(), T.DateType())


def table(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_numbers = [c for c in fv.PLAYER_FACT_COLUMNS if c not in ("minute", "id_joueur")]

STORED = {
    "joueur": table(("id_joueur", L), ("nom", S), ("nom_simple", S), ("taille", D), ("poids", D),
                    ("date_naissance", DT), ("date_entree_nba", DT), ("date_sortie_nba", DT),
                    ("id_position_terrain", S)),
    "equipe": table(("id_equipe", S), ("nom_equipe", S), ("conference", S), ("division", S)),
    "contrat": table(("id_contrat", L), ("id_joueur", L), ("id_equipe", S),
                     ("date_debut_contrat", DT), ("date_fin_contrat", DT)),
    "blessure": table(("id_blessure", L), ("id_joueur", L), ("id_type_blessure", I),
                      ("date_blessure", DT), ("date_guerison", DT)),
    "match": table(("id_match", L), ("id_saison", I), ("date_match", DT), ("equipe_domicile", S),
                   ("equipe_exterieure", S), ("id_type_match", I)),
    "score_match": table(("id_equipe", S), ("id_periode", S), ("score_periode", I), ("id_match", L)),
    "stats_equipes": table(("id_equipe", S), *[(c, D) for c in fv.TEAM_STAT_COLUMNS[1:]], ("id_match", L)),
    "stats_joueur": table(("minute", S), *[(c, D) for c in _numbers], ("id_joueur", L), ("id_match", L)),
    # What was seen of a player on a day: the team of the last game, and whether a game named an injury.
    "presence": table(("id_joueur", L), ("date_match", DT), ("id_equipe", S), ("game_no", L), ("team_idx", I), ("blesse", B)),
    "calendrier": table(("equipe_exterieure", S), ("equipe_domicile", S), ("date_match", DT), ("id_saison", I)),
    "joueurs_choisis": table(("date_choix", DT), ("id_joueur", L), ("saison", I)),
    "enum_type_blessure": table(("id_type_blessure", I), ("nom_blessure", S), ("nom_blessure_anglais", S)),
    "enum_position_terrain": table(("id_position_terrain", S), ("nom_position_terrain", S)),
}

# What an import leaves out, and why.
REJECTS = {
    "rejected_rows": table(("game_date", DT), ("game_no", L), ("team_idx", I), ("row_idx", I), ("nom", S), ("rejected", S)),
    "rejected_games": table(("game_date", DT), ("game_no", L), ("reason", S)),
    "rejected_injuries": table(("Player", S), ("Updated", S), ("Injury", S), ("reason", S)),
    "rejected_pages": table(("game_date", DT), ("game_no", L), ("kind", S)),
}

# Small state of a streamed import: greatest ids given, and the last game day of each player.
LAST_IDS = table(("name", S), ("last_id", L))
LAST_SEEN = table(("id_joueur", L), ("date_match", DT))
