"""Keeping one hot key from ending up in one task.

Rules used throughout:
* groups are reduced by aggregates, which combine on the map side, never by an open-ended window;
* windows run only over one row per (key, day), so a group is at most as long as the calendar;
* fact-to-key joins are left to AQE, which splits a hot partition of the fact side at run time. It
  can do so only if both inputs come straight from a shuffle made for the join. An aggregate on the
  join key would lend its own shuffle and switch that off, so such a side is shuffled again, after
  it has been reduced, by `own_shuffle`.
"""

from pyspark.sql import DataFrame


def own_shuffle(df: DataFrame) -> DataFrame:
    """Detach a reduced frame from the partitioning of its aggregate."""
    return df.hint("rebalance")


def member_keys(df: DataFrame, keys) -> DataFrame:
    """The distinct keys, as the right side of a semi or anti join."""
    return own_shuffle(df.select(*keys).distinct())
