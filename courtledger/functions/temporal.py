"""Playing time, partial dates and day arithmetic. "Now" is always an argument."""

from pyspark.sql import Column, functions as F

from courtledger import fixed_values as fv
from courtledger.functions.text import as_column, contains_any

# MM:SS, MM.SS or the damaged form MM.000000:SS.
_MINUTES = r"^\s*(\d+)(?:\.\d+)?:(\d+)\s*$"
_DOTTED = r"^\s*(\d+)\.(\d+)\s*$"


def _clock(c):
    """(minutes, seconds) as texts, null where the text is no clock."""
    colon = F.regexp_extract(c, _MINUTES, 1) != ""
    pattern = lambda i: F.when(colon, F.regexp_extract(c, _MINUTES, i)).otherwise(
        F.regexp_extract(c, _DOTTED, i))
    return tuple(F.nullif(pattern(i), F.lit("")) for i in (1, 2))


def parse_minutes(c) -> Column:
    """Day-time interval of a clock text; null for null and for anything else."""
    minutes, seconds = (p.try_cast("int") for p in _clock(as_column(c)))
    return F.make_dt_interval(F.lit(0), F.lit(0), minutes, seconds.cast("decimal(18,6)"))


def interval_seconds(c) -> Column:
    c = as_column(c)
    part = lambda unit: F.extract(F.lit(unit), c).cast("long")
    return part("DAY") * 86400 + part("HOUR") * 3600 + part("MINUTE") * 60 + part("SECOND")


def format_duration(c) -> Column:
    """HH:MM:SS without the days; empty text for null."""
    c = as_column(c)
    part = lambda unit: F.lpad(F.extract(F.lit(unit), c).cast("int").cast("string"), 2, "0")
    clock = F.concat_ws(":", part("HOUR"), part("MINUTE"), part("SECOND"))
    return F.when(c.isNull(), F.lit("")).otherwise(clock)


def is_dnp(c) -> Column:
    """Did not play: a marker text or a zero clock. No text is false, an unreadable one null."""
    c = as_column(c)
    minutes, seconds = (p.try_cast("int") for p in _clock(c))
    damaged = c.contains(".") & c.contains(":")
    return (F.when(c.isNull(), F.lit(False))
             .when(contains_any(c, fv.DID_NOT_PLAY_TEXTS), F.lit(True))
             .when(damaged, (minutes == 0) & (seconds == 0))
             .otherwise(F.replace(c, F.lit(":"), F.lit(".")).try_cast("double") == 0))


def is_injured(c) -> Column:
    return F.coalesce(as_column(c).contains(fv.INJURY_TEXT), F.lit(False))


def infer_year(c, ref) -> Column:
    """Date of "Sat, Mar 4": in the year of ref, or the year before if it would lie after ref."""
    ref = ref if isinstance(ref, Column) else F.lit(ref)
    day = F.get(F.split(as_column(c), ", "), 1)

    def in_year(y):
        return F.to_date(F.try_to_timestamp(F.concat_ws(" ", day, y.cast("string")),
                                            F.lit("MMM d yyyy")))

    this_year = in_year(F.year(ref))
    return F.when(this_year <= F.to_date(ref), this_year).otherwise(in_year(F.year(ref) - 1))


def entry_date(c, ref_year) -> Column:
    """First of October of the year a career began, from "3 Years" or "Rookie"."""
    c = as_column(c)
    years = F.when(c == "Rookie", 0).otherwise(F.regexp_extract(c, r"^\s*(\d+)", 1).try_cast("int"))
    return F.make_date(F.lit(ref_year) - years, F.lit(10), F.lit(1))


def day_before(c) -> Column:
    return F.date_sub(as_column(c), 1)


def day_after(c) -> Column:
    return F.date_add(as_column(c), 1)


def days_to_import(first_day, ref) -> Column:
    """Whole days from the first missing day to the reference day."""
    ref = ref if isinstance(ref, Column) else F.lit(ref)
    return F.datediff(ref, as_column(first_day))


def iso_date(c) -> Column:
    return F.date_format(as_column(c), "yyyy-MM-dd")
