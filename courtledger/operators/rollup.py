"""Grouped statistics that a batch adds to.

A batch is reduced to one row of mergeable parts per group (counts, sums, sums of squares, extremes, and sketches of distinct
values); parts are stored by batch and merged when they are read, at any coarser grouping. So no batch is read twice, and a
batch that is repeated replaces its own parts. Sketches are estimates, all else is exact for exact types.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from courtledger.sources.tables import finished_versions, path_exists, prune

#: Batches whose parts are merged into one from time to time.
FOLD = 16


def partial_stats(rows: DataFrame, keys, measures, distinct=()) -> DataFrame:
    """One row per group: n, and for each measure m its n_m (not null), sum_m, squares_m, min_m, max_m; a sketch_c per column of `distinct`."""
    of = lambda m: [F.count(m).alias(f"n_{m}"), F.sum(m).alias(f"sum_{m}"), F.sum(F.col(m).cast("double") * F.col(m)).alias(f"squares_{m}"),
                    F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
    sketches = [F.hll_sketch_agg(F.col(c).cast("string")).alias(f"sketch_{c}") for c in distinct]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[a for m in measures for a in of(m)], *sketches)


def _merge(column):
    if column.startswith("sketch_"):
        return F.hll_union_agg(column).alias(column)
    how = F.min if column.startswith("min_") else F.max if column.startswith("max_") else F.sum
    return how(column).alias(column)


def merge_stats(parts: DataFrame, keys) -> DataFrame:
    """Parts of the same group, or of a coarser one, as one row."""
    return parts.groupBy(*keys).agg(*[_merge(c) for c in parts.columns if c not in _all_keys(parts)])


def _all_keys(parts):
    first = parts.columns.index("n")
    return parts.columns[:first]


def grouping_sets(parts: DataFrame, sets, names="sets") -> DataFrame:
    """Merged parts at several groupings at once: keys that a grouping leaves out are null, and `names` lists those it has."""
    keys = _all_keys(parts)
    level = F.array_join(F.array_compact(F.array(*[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys])), ",")
    cols = [[F.col(k) for k in s] for s in sets]
    merged = parts.groupingSets(cols, *[F.col(k) for k in keys]).agg(level.alias(names), *[_merge(c) for c in parts.columns if c not in keys])
    return merged.select(*keys, names, *[c for c in parts.columns if c not in keys])


def finished(parts: DataFrame, measures, distinct=()) -> DataFrame:
    """Means, deviations and numbers of distinct values in place of sums and sketches."""
    n, s, q = (lambda m: F.col(f"n_{m}")), (lambda m: F.col(f"sum_{m}").cast("double")), (lambda m: F.col(f"squares_{m}"))
    mean = lambda m: F.when(n(m) > 0, s(m) / n(m))
    spread = lambda m: F.when(n(m) > 1, F.sqrt(F.greatest((q(m) - s(m) * s(m) / n(m)) / (n(m) - 1), F.lit(0.0))))
    out = parts.select("*", *[f(m).alias(f"{name}_{m}") for m in measures for name, f in (("mean", mean), ("deviation", spread))],
                       *[F.hll_sketch_estimate(f"sketch_{c}").alias(f"about_{c}") for c in distinct])
    return out.drop(*[f"squares_{m}" for m in measures], *[f"sketch_{c}" for c in distinct])


def store_parts(parts: DataFrame, path, batch_id) -> None:
    """The parts of a batch, in a folder of its own; a repetition replaces it."""
    parts.write.mode("overwrite").parquet(f"{path}/parts/batch={batch_id}")


def read_parts(spark: SparkSession, path, schema: T.StructType, before=None) -> DataFrame:
    """The parts of all batches, or of those before one, merged."""
    base = max((v for v in finished_versions(spark, f"{path}/base") if before is None or v < before), default=-1)
    frames = [spark.read.schema(schema).parquet(f"{path}/base/v={base}")] if base >= 0 else []
    if path_exists(spark, f"{path}/parts"):
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(f"{path}/parts")
        later = rows.filter((F.col("batch") > base) & (F.lit(True) if before is None else F.col("batch") < before))
        frames.append(later.select(*schema.fieldNames()))
    parts = frames[0] if frames else spark.createDataFrame([], schema)
    for frame in frames[1:]:
        parts = parts.unionByName(frame)
    return merge_stats(parts, _all_keys(parts))


def fold_parts(spark: SparkSession, path, schema: T.StructType, batch_id, every=FOLD) -> bool:
    """Merge the parts up to a finished batch into one base, every so many batches. The base before it and later parts stay for repetitions."""
    base = max((v for v in finished_versions(spark, f"{path}/base") if v <= batch_id), default=-1)
    if batch_id - base < every:
        return False
    read_parts(spark, path, schema, batch_id + 1).write.mode("overwrite").parquet(f"{path}/base/v={batch_id}")
    prune(spark, f"{path}/base", "v=", base)
    prune(spark, f"{path}/parts", "batch=", base + 1)
    return True
