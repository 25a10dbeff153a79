"""Stored tables and flat files."""

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from courtledger.functions.text import as_column

#: Folder of the finished batches of streamed tables; readers of tables skip names that begin so.
COMMITS = "_commits"


def read_table(spark: SparkSession, path, columns=None, where=None) -> DataFrame:
    """Parquet table; columns and filter reach the scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def inline_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A small table from literals."""
    return spark.createDataFrame(rows, schema)


def date_series(spark: SparkSession, start, n) -> DataFrame:
    """n days from start on, as dates and as YYYY-MM-DD texts."""
    days = (spark.range(n)
            .select(F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int")).alias("day")))
    return days.select("day", F.date_format("day", "yyyy-MM-dd").alias("day_text"))


def filesystem(spark, path):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path) -> bool:
    fs, p = filesystem(spark, path)
    return fs.exists(p)


def append_rows(df: DataFrame, path, partition_by=()) -> None:
    """Append by column name: same columns as the stored ones, in whatever order."""
    spark = df.sparkSession
    if path_exists(spark, path):
        stored = spark.read.parquet(path).columns
        if set(stored) != set(df.columns):
            raise ValueError(f"columns {sorted(df.columns)} do not match the stored {sorted(stored)}")
        df = df.select(*stored)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path, mode="errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_csv(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_json(df: DataFrame, path, mode="errorifexists") -> None:
    df.write.mode(mode).json(path)


def create_tables(spark: SparkSession, schemas, root, names=None) -> None:
    """Write an empty table for every declared schema that is not there yet."""
    for name in names or schemas:
        path = f"{root}/{name}"
        if not path_exists(spark, path):
            spark.createDataFrame([], schemas[name]).write.parquet(path)


def finished_versions(spark: SparkSession, root) -> list:
    """Numbers of the versions under root that were written to their end."""
    fs, p = filesystem(spark, root)
    found = [re.fullmatch(r"v=(\d+)", s.getPath().getName()) for s in fs.listStatus(p)] if fs.exists(p) else []
    return [int(m.group(1)) for m in found if m and path_exists(spark, f"{root}/{m.group()}/_SUCCESS")]


def latest_version(spark: SparkSession, root) -> int:
    """Highest finished version under root; -1 if there is none."""
    return max(finished_versions(spark, root), default=-1)


def commit_batch(spark: SparkSession, root, batch_id) -> None:
    """Mark a batch as finished: the last thing that is written of it."""
    fs, p = filesystem(spark, f"{root}/{COMMITS}/{batch_id}")
    fs.create(p, True).close()


def last_commit(spark: SparkSession, root) -> int:
    """The newest finished batch; -1 if there is none. One listing, of the batches kept."""
    fs, p = filesystem(spark, f"{root}/{COMMITS}")
    if not fs.exists(p):
        return -1
    return max((int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()), default=-1)


def prune(spark: SparkSession, folder, prefix, before) -> None:
    """Remove the entries prefix<number> of a folder with a number below `before`."""
    fs, p = filesystem(spark, folder)
    for status in fs.listStatus(p) if fs.exists(p) else []:
        match = re.fullmatch(re.escape(prefix) + r"(\d+)", status.getPath().getName())
        if match and int(match.group(1)) < before:
            fs.delete(status.getPath(), True)


def remove(spark: SparkSession, path) -> None:
    fs, p = filesystem(spark, path)
    fs.delete(p, True)


def version_path(root, version) -> str:
    return f"{root}/v={version}"


def read_version(spark: SparkSession, root, version, schema) -> DataFrame:
    """A stored version; version -1 is the empty table."""
    if version < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version_path(root, version))


def write_version(df: DataFrame, root, version=None) -> int:
    """Write a whole new version next to the ones being read; older versions stay untouched."""
    if version is None:
        version = latest_version(df.sparkSession, root) + 1
    df.write.mode("overwrite").parquet(version_path(root, version))
    return version


def chosen_groups(outputs, groups="all") -> list:
    """The names of the groups to publish: those listed, or all of them."""
    if isinstance(groups, str):
        if groups != "all":
            raise ValueError('groups must be a list of group names or "all"')
        groups = list(outputs)
    unknown = [g for g in groups if g not in outputs]
    if unknown:
        raise ValueError(f"unknown groups: {unknown}")
    return groups


def publish(outputs, root, groups="all", writer=None):
    """Write the chosen groups of named frames: {"match": {"match": df, ...}, "stats": {...}}.

    groups is a list of group names or "all". Returns the names written. Tables are written one by one and a second call
    appends again: `manifest.publish_once` publishes all or nothing, and once.
    """
    writer = writer or append_rows
    written = []
    for group in chosen_groups(outputs, groups):
        for name, df in outputs[group].items():
            writer(df, f"{root}/{name}")
            written.append(name)
    return written


def max_of_all(columns: dict) -> dict:
    """Largest values of columns of several frames in one job: {name: (frame, column)} to {name: value or None}."""
    rows = [df.agg(F.max(as_column(column)).cast("long").alias("m")).select(F.lit(name).alias("name"), "m") for name, (df, column) in columns.items()]
    if not rows:
        return {}
    return {r["name"]: r["m"] for r in reduce(DataFrame.unionByName, rows).collect()}


def max_of(df: DataFrame, column, default=None):
    """Largest value of a column on the driver: one row, one number."""
    value = df.agg(F.max(as_column(column)).alias("m")).first()["m"]
    return default if value is None else value
