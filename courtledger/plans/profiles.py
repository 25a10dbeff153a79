"""Player dimension from profile pages, and the team and position dimensions."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from courtledger import fixed_values as fv
from courtledger.functions.text import height_m, join_slice, normalize_name, position_code, weight_kg
from courtledger.operators.matching import invert, lookup

# Where birth date, draft and experience stand, by number of values on the page.
PROFILE_PLACES = {11: (4, 5, 6), 12: (5, 6, 7)}


def _placed(values, which) -> Column:
    n = F.size(values)
    out = F.lit(None).cast("string")
    for size, places in PROFILE_PLACES.items():
        out = F.when(n == size, F.get(values, places[which])).otherwise(out)
    return out


def parse_profile(profiles: DataFrame, link="link", values="values", header="header") -> DataFrame:
    """Typed attributes from (link, values array, header array); pages without values drop out."""
    v, h = F.col(values), F.col(header)
    name = join_slice(h, F.lit(1), 2)
    return profiles.filter(F.size(v) > 0).select(
        height_m(F.get(v, 0)).alias("taille"),
        weight_kg(F.get(v, 1)).alias("poids"),
        F.get(v, 2).alias("pays"),
        F.to_date(F.try_to_timestamp(_placed(v, 0), F.lit("MMMM d, yyyy"))).alias("date_naissance"),
        _placed(v, 1).alias("draft"),
        _placed(v, 2).alias("experience"),
        name.alias("nom"),
        normalize_name(name).alias("nom_simple"),
        position_code(F.get(h, 0)).alias("id_position_terrain"),
        F.col(link).alias("page_web"))


def player_dimension(profiles: DataFrame, links: DataFrame | None = None, link="link", **columns) -> DataFrame:
    """Profiles of all pages, or only of the links given."""
    if links is not None:
        profiles = profiles.join(links.select(link).distinct(), link, "left_semi")
    return parse_profile(profiles, link=link, **columns)


def team_dimension(spark: SparkSession) -> DataFrame:
    """Teams with name, division and conference."""
    division = lookup("id_equipe", invert(fv.DIVISIONS))
    conference = lookup("division", invert(fv.CONFERENCES))
    return (spark.createDataFrame(list(fv.TEAM_NAMES.items()), "id_equipe string, nom_equipe string")
            .withColumn("division", division).withColumn("conference", conference))


def position_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(fv.POSITIONS, "id_position_terrain string, nom_position_terrain string")
