"""Surrogate keys."""

from pyspark.sql import DataFrame, Window, functions as F

from courtledger.operators.matching import drop_members
from courtledger.session import cut_lineage

# monotonically_increasing_id keeps the row number within a task in its lower 33 bits.
_ROW_BITS = 33


def allocate_ids(df: DataFrame, id_col, order, after=0) -> DataFrame:
    """Dense ids after+1, after+2, ... in the given order, which has to be total.

    Rows are range-partitioned and sorted once and stored with their place, so that the counts and
    the rows they number agree even if tasks are repeated. Only the counts, one row per partition,
    are summed up in a single task.
    """
    columns = df.columns
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("_place", F.monotonically_increasing_id()))
    task = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
              .select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    # One row per task of one stage: a size the partition count bounds.
    numbered = placed.withColumn("_task", task).join(F.broadcast(counts), "_task")
    return numbered.select((F.lit(after) + F.col("_before") + row + 1).cast("long").alias(id_col),
                           *[c for c in columns if c != id_col])


def new_members(dim: DataFrame, facts: DataFrame, on, columns, id_col, after) -> DataFrame:
    """One row with a fresh id per key of the facts that the dimension lacks.

    If facts spell a member differently, the greatest spelling is taken. Facts are reduced to one row
    per key before they meet the dimension.
    """
    rest = [c for c in columns if c not in on]
    facts = facts.select(*columns).filter(" AND ".join(f"`{c}` IS NOT NULL" for c in on))
    met = facts.groupBy(*on).agg(*[F.max(c).alias(c) for c in rest]) if rest else facts.distinct()
    return allocate_ids(drop_members(met, dim, on, hot=False), id_col, on, after)


def add_members(dim: DataFrame, facts: DataFrame, on, columns, id_col, after) -> DataFrame:
    """The dimension with its new members."""
    return dim.unionByName(new_members(dim, facts, on, columns, id_col, after), allowMissingColumns=True)
