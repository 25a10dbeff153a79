"""Columns from positions, rows from columns, and edits by row position."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from courtledger import fixed_values as fv
from courtledger.functions.text import as_column


def rename_by_position(df: DataFrame, names) -> DataFrame:
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, {len(names)} names")
    return df.toDF(*names)


def cells_to_columns(df: DataFrame, names, cells="cells", keep=()) -> DataFrame:
    """Name the items of an array column by position; items that are not there are null."""
    return df.select(*keep, *[F.get(F.col(cells), i).alias(n) for i, n in enumerate(names)])


def period_names(n_periods) -> Column:
    """q1..q4, then one overtime name per extra period, then final.

    The usual widths, up to two overtimes, are constants; others are put together row by row.
    """
    def names(overtimes):
        extra = [f"{fv.OVERTIME_PREFIX}{i + 1}" for i in range(overtimes)]
        return F.array(*[F.lit(p) for p in [*fv.REGULAR_PERIODS, *extra, fv.FINAL_PERIOD]])

    extra = as_column(n_periods) - len(fv.REGULAR_PERIODS) - 1
    overtimes = F.transform(F.sequence(F.lit(1), F.greatest(extra, F.lit(1))),
                            lambda i: F.concat(F.lit(fv.OVERTIME_PREFIX), i.cast("string")))
    regular = F.array(*[F.lit(p) for p in fv.REGULAR_PERIODS])
    return (F.when(extra == 0, names(0)).when(extra == 1, names(1)).when(extra == 2, names(2))
             .otherwise(F.concat(regular, overtimes, F.array(F.lit(fv.FINAL_PERIOD)))))


def period_map(values) -> Column:
    """Map period -> value from an array whose width says how many overtimes there were.

    Null if there are fewer values than a game without overtime has.
    """
    values = as_column(values)
    n = F.size(values)
    return F.when(n > len(fv.REGULAR_PERIODS), F.map_from_arrays(period_names(n), values))


def cast_measures(df: DataFrame, keep=(), rejects="rejected") -> DataFrame:
    """Every column but the kept ones as double; names of unreadable columns go to `rejects`."""
    measures = [c for c in df.columns if c not in keep]
    bad = [F.when(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull(), F.lit(c)) for c in measures]
    out = [F.col(c).try_cast("double").alias(c) if c in measures else F.col(c) for c in df.columns]
    if rejects:
        out.append(F.array_compact(F.array(*bad)).alias(rejects))
    return df.select(*out)


def null_where(df: DataFrame, condition, keep=()) -> DataFrame:
    """Empty every column but the kept ones on rows where the condition holds."""
    hold = F.coalesce(condition, F.lit(False))
    return df.select(*[F.col(c) if c in keep else F.when(~hold, F.col(c)).alias(c) for c in df.columns])


def linear_score(gains, losses=(), made_attempted=(), when=None) -> Column:
    """Gains minus losses minus misses (attempted - made); null where `when` does not hold."""
    plus = reduce(Column.__add__, [as_column(c) for c in gains])
    minus = [as_column(c) for c in losses]
    minus += [as_column(attempted) - as_column(made) for made, attempted in made_attempted]
    score = plus - reduce(Column.__add__, minus) if minus else plus
    return score if when is None else F.when(when, score)


def melt(df: DataFrame, id_cols, value_cols=None, variable="variable", value="value") -> DataFrame:
    """One row per id and value column."""
    value_cols = value_cols or [c for c in df.columns if c not in id_cols]
    return df.unpivot(list(id_cols), list(value_cols), variable, value)


def melt_map(df: DataFrame, id_cols, map_col, variable="variable", value="value") -> DataFrame:
    """One row per id and map entry; rows may have different entries."""
    return df.select(*id_cols, F.explode(map_col).alias(variable, value))


def pivot_pair(df: DataFrame, keys, index, value, names) -> DataFrame:
    """Rows 0, 1, ... of a key side by side: names[i] holds the value of the row with index i."""
    return df.groupBy(*keys).agg(*[
        F.max(F.when(as_column(index) == i, as_column(value))).alias(n) for i, n in enumerate(names)])


def drop_footer(df: DataFrame, group, order) -> DataFrame:
    """Drop the last row of every group, or of the whole frame if group is empty.

    The last position of each group is found by an aggregate and removed by an anti join on group
    AND position, so a long group stays spread over all tasks.
    """
    group, order = list(group), list(order)
    position = F.struct(*order)
    if group:
        last = df.groupBy(*group).agg(F.max(position).alias("_last"))
    else:
        last = df.agg(F.max(position).alias("_last"))
    last = last.select(*group, *[F.col(f"_last.{c}").alias(c) for c in order])
    return df.join(last, [*group, *order], "left_anti")


def edit_head(df: DataFrame, column, order, n, edit) -> DataFrame:
    """Apply an expression to a column on the first n rows (order counts from 0)."""
    c = F.col(column)
    return df.withColumn(column, F.when(as_column(order) < n, edit(c)).otherwise(c))


def drop_last_char(c) -> Column:
    c = as_column(c)
    return F.substring(c, F.lit(1), F.length(c) - 1)


def union_by_name(frames, empty=None) -> DataFrame:
    """All rows; columns a frame lacks are null. No frames: the empty frame given."""
    frames = list(frames)
    if not frames:
        if empty is None:
            raise ValueError("no frames and no empty frame given")
        return empty
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def score_line(df: DataFrame, keys, team, periods="periods") -> DataFrame:
    """Team and final score."""
    return df.select(*keys, team, F.try_element_at(periods, F.lit(fv.FINAL_PERIOD)).alias(fv.FINAL_PERIOD))
