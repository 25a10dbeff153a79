"""Per-day folders of small CSV sheets, one file per game or per team of a game.

Column positions differ between files: a game with overtime has more columns, so a sheet's own header
names its fields. Small sheets are read whole (`read_day_folders`), large ones by lines (`read_split_sheets`).
"""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from courtledger import fixed_values as fv
from courtledger.operators.skew import own_shuffle
from courtledger.session import cut_lineage

# Fixed value: where date, game and team stand in a path; the team is missing in game files.
SHEET_PATH = r"(\d{4}-\d{2}-\d{2})/m(\d+)_(?:equipe(\d+)_)?\1\.csv$"


def parse_sheets(sheets: DataFrame, path_col="path", text_col="value") -> DataFrame:
    """(game_date, game_no, team_idx, row_idx, fields map) from whole-file texts.

    fields is null for a line whose width differs from the header; see `rejected_lines`.
    """
    lines = F.filter(F.split(F.col(text_col), r"\r?\n"), lambda line: line != "")
    return _located_lines(sheets.select(
        F.col(path_col).alias("path"), F.split(F.get(lines, 0), ",").alias("_header"),
        F.posexplode(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).alias("row_idx", "_line")))


def _located_lines(lines: DataFrame) -> DataFrame:
    """Lines (path, _header, row_idx, _line) with the date, game and team of their path, and their fields by the header."""
    part = lambda i: F.regexp_extract("path", SHEET_PATH, i)
    located = lines.select(
        part(1).try_cast("date").alias("game_date"),
        part(2).try_cast("int").alias("game_no"),
        part(3).try_cast("int").alias("team_idx"), "_header", "row_idx", "_line").filter(F.col("game_date").isNotNull())
    values = F.split("_line", ",", -1)
    return located.select(
        "game_date", "game_no", "team_idx", "row_idx", F.col("_line").alias("line"),
        F.when(F.size(values) == F.size("_header"), F.map_from_arrays("_header", values)).alias("fields"))


def read_split_sheets(spark: SparkSession, path: str) -> DataFrame:
    """`read_day_folders` for sheets of any size: a sheet is read by lines, in as many tasks as it has splits.

    The header is found once per file, where its first split begins. A line's place in its file is its place in its split plus
    the lines of the splits before; only counts, one row per split, are summed up for that.
    """
    lines = (spark.read.text(path, pathGlobFilter="m*.csv", recursiveFileLookup=True)
             .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_split"), F.col("value").alias("line"))
             .filter("line <> ''").withColumn("_id", F.monotonically_increasing_id()))
    # Stored once, so that counts and lines agree even if tasks are repeated.
    lines = cut_lineage(lines)
    splits = lines.groupBy("path", "_split").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"), F.min_by("line", "_id").alias("_line"))
    in_file = Window.partitionBy("path").orderBy("_split")  # a file's splits
    before = F.coalesce(F.sum("_n").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    header = F.first("_line").over(in_file.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    places = own_shuffle(splits.select("path", "_split", "_first", before.alias("_before"), F.split(header, ",").alias("_header")))
    located = lines.join(places, ["path", "_split"]).withColumn("_place", F.col("_before") + F.col("_id") - F.col("_first"))
    return _located_lines(located.filter("_place > 0").withColumn("row_idx", (F.col("_place") - 1).cast("int")).withColumnRenamed("line", "_line"))


def read_day_folders(spark: SparkSession, path: str) -> DataFrame:
    """All sheets under path/<date>/."""
    sheets = (spark.read.text(path, wholetext=True, pathGlobFilter="m*.csv", recursiveFileLookup=True)
              .select("value", F.col("_metadata.file_path").alias("path")))
    return parse_sheets(sheets)


def rejected_sheets(sheets: DataFrame, path_col="path") -> DataFrame:
    """Sheets whose path names no game, or no day of the calendar, so that none of their lines is read."""
    day = F.regexp_extract(F.col(path_col), SHEET_PATH, 1).try_cast("date")
    return sheets.filter(day.isNull()).select(path_col)


def rejected_lines(sheets: DataFrame) -> DataFrame:
    """Lines that neither `game_rows` nor `player_rows` takes: their width is not the header's."""
    return sheets.filter(F.col("fields").isNull()).select("game_date", "game_no", "team_idx", "row_idx", "line")


def _field(name):
    return F.nullif(F.try_element_at("fields", F.lit(name)), F.lit(""))


def game_rows(sheets: DataFrame) -> DataFrame:
    """Team rows of game files with a map period -> points; row 0 is away, row 1 at home."""
    team = F.coalesce(_field(fv.TEAM_COLUMN), _field("equipe"))
    periods = F.map_filter("fields", lambda k, v: ~k.isin(fv.TEAM_COLUMN, "equipe"))
    return sheets.filter(F.col("team_idx").isNull() & F.col("fields").isNotNull()).select(
        "game_date", "game_no", F.col("row_idx").alias("team_idx"),
        team.alias(fv.TEAM_COLUMN),
        F.transform_values(periods, lambda k, v: v.try_cast("int")).alias("periods"))


def player_rows(sheets: DataFrame) -> DataFrame:
    """Player rows of team files, typed; minute becomes an interval.

    The stored score column follows an older formula and is kept as stored_score.
    """
    numbers = [c for c in fv.PLAYER_COLUMNS if c not in ("nom", "minute")]
    clock = F.regexp_extract(_field("minute"), r"(\d+):(\d+):(\d+)$", 0)
    h, m, s = (F.try_element_at(F.split(clock, ":"), F.lit(i)).try_cast("int") for i in (1, 2, 3))
    return sheets.filter(F.col("team_idx").isNotNull() & F.col("fields").isNotNull()).select(
        "game_date", "game_no", "team_idx", "row_idx",
        _field("nom").alias("nom"),
        F.make_dt_interval(F.lit(0), h, m, s.cast("decimal(18,6)")).alias("minute"),
        *[_field(c).try_cast("double").alias(c) for c in numbers],
        *[F.coalesce(F.lower(_field(c)) == "true", F.lit(False)).alias(c) for c in ("dnp", "blesse")],
        _field("nom_simple").alias("nom_simple"),
        _field(fv.SCORE_COLUMN).try_cast("double").alias("stored_score"))
