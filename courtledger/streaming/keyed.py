"""Keyed state as changes.

A batch writes only the rows that it changes, each with its key and whether it is gone; of a key, the newest batch counts.
From time to time the state is folded into a base, so that readers need not go through all batches: as soon as the changes
since the last base are more rows than that base has. So all bases together cost no more than about twice what the batches
wrote, and a batch never rewrites what it does not change.

A base counts as soon as it is finished and never before its batch is; the base before it and the changes since then are kept, so that
a batch can be repeated after a failure.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from courtledger.operators.skew import own_shuffle
from courtledger.sources.tables import finished_versions, path_exists, prune

GONE = "gone"
#: A base is not worth its while for fewer changes.
LEAST_CHANGES = 10_000


class Keyed(NamedTuple):
    schema: T.StructType
    key: tuple
    sort: str | None = None  # a base is sorted by it, so that a filter on it skips most of a base

    def changes(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(GONE, T.BooleanType())])


class Parted(NamedTuple):
    """Rows of a log that are stored in a folder per value of a column."""
    rows: DataFrame
    by: str


def _base(spark, path, before):
    return max((v for v in finished_versions(spark, f"{path}/base") if v < before), default=-1)


def _changes(spark, path, keyed, after, before) -> DataFrame:
    fields = T.StructType([*keyed.changes().fields, T.StructField("batch", T.LongType())])
    if not path_exists(spark, f"{path}/changes"):
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).parquet(f"{path}/changes").filter((F.col("batch") > after) & (F.col("batch") < before))


def read_keyed(spark: SparkSession, path, keyed: Keyed, before, where=None) -> DataFrame:
    """The rows as of the batches before one. `where`, a condition, is applied to what holds now; it reaches the scan of the base."""
    base = _base(spark, path, before)
    columns = keyed.schema.fieldNames()
    changes = _changes(spark, path, keyed, base, before)
    newest = (changes.groupBy(*keyed.key).agg(F.max_by(F.struct(*columns, GONE), "batch").alias("_row")))
    out = newest.filter(f"NOT _row.{GONE}").select("_row.*").drop(GONE)
    if where is not None:
        out = out.filter(where)
    if base >= 0:
        stored = spark.read.schema(keyed.schema).parquet(f"{path}/base/v={base}")
        stored = stored if where is None else stored.filter(where)
        touched = own_shuffle(newest.select(*[F.col(k).alias(f"_{k}") for k in keyed.key]))
        on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keyed.key]
        out = stored.join(touched, on, "left_anti").unionByName(out)
    # The declared columns as they are declared, whether or not they can be null.
    return out.select(*columns)


def write_changes(df: DataFrame, path, keyed: Keyed, batch_id) -> None:
    """The rows that a batch adds or replaces, or whose column `gone` is true; running it again writes the same folder."""
    gone = F.coalesce(F.col(GONE), F.lit(False)) if GONE in df.columns else F.lit(False)
    df.select(*keyed.schema.fieldNames(), gone.alias(GONE)).write.mode("overwrite").parquet(f"{path}/changes/batch={batch_id}")


def changes(changed: DataFrame, gone: DataFrame, key) -> DataFrame:
    """Rows to write, and rows that are no more; a row that is replaced by one of its key is not gone."""
    left = gone.join(own_shuffle(changed.select(*key).distinct()), list(key), "left_anti")
    return changed.withColumn(GONE, F.lit(False)).unionByName(left.withColumn(GONE, F.lit(True)))


def fold(spark: SparkSession, path, keyed: Keyed, batch_id) -> bool:
    """Write a base as of a finished batch if the changes since the last one have become more than it."""
    base = _base(spark, path, batch_id + 1)
    n_changes = _changes(spark, path, keyed, base, batch_id + 1).count()
    n_base = spark.read.schema(keyed.schema).parquet(f"{path}/base/v={base}").count() if base >= 0 else 0
    if n_changes < max(n_base, LEAST_CHANGES):
        return False
    rows = read_keyed(spark, path, keyed, batch_id + 1)
    if keyed.sort:
        rows = rows.repartitionByRange(F.col(keyed.sort)).sortWithinPartitions(keyed.sort)
    rows.write.mode("overwrite").parquet(f"{path}/base/v={batch_id}")
    prune(spark, f"{path}/base", "v=", base)
    prune(spark, f"{path}/changes", "batch=", base + 1)
    return True
