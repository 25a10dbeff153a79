"""Helpers shared by the operators of this subpackage."""

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.skew import own_shuffle

#: Rows handed to a Python worker at once; texts may be long, so few rows and a bound in bytes where Spark has one.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def table(spark, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(df, id_col="doc_id", text_col="text", id_name="doc_id", text_name="text") -> DataFrame:
    """Only the id and the text, whatever else the frame holds; a null text counts as empty."""
    return df.select(df[id_col].cast("long").alias(id_name), F.coalesce(df[text_col].cast("string"), F.lit("")).alias(text_name))


def bounded_batches(spark) -> None:
    """A Python worker holds a batch at a time: keep it small, unless the session already asks for less."""
    for key, value in BATCH.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def map_batches(df, step, schema) -> DataFrame:
    """`step(batch)` gives the columns of the result for each Arrow batch, in one pass and without a shuffle."""
    bounded_batches(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(step(batch), schema=out)
    return df.mapInArrow(run, schema)


#: Bits of one bitmap of Spark's `bitmap_construct_agg`, and bitmaps at most: 16 MB in all, whatever the data.
BITMAP, BITMAPS = 32_768, 4096


def _marked(df: DataFrame, ids: DataFrame, id_col) -> DataFrame:
    """The rows with `__likely`: false means that the id is certainly not among `ids` (one column, stored).

    The ids are folded into a bitmap by a hash; it has a fixed greatest size and goes to every task. With more ids than it is
    made for, more rows are marked, never fewer.
    """
    n_bitmaps = 1 << min(BITMAPS.bit_length() - 1, max(0, (16 * ids.count() // BITMAP).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c.cast("long")), F.lit(n_bitmaps * BITMAP)) + 1
    bitmaps = (ids.select(place(ids[ids.columns[0]]).alias("__at")).groupBy(F.bitmap_bucket_number("__at").alias("__bitmap"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__at")).alias("__bits")))
    at = F.bitmap_bit_position("__at").cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.floor(byte / F.pow(F.lit(2), F.pmod(at, F.lit(8)))) % 2 == 1
    rows = df.withColumn("__at", place(df[id_col])).withColumn("__bitmap", F.bitmap_bucket_number("__at"))
    return rows.join(F.broadcast(bitmaps), "__bitmap", "left").withColumn("__likely", F.coalesce(there, F.lit(False))).drop("__at", "__bitmap", "__bits")


def likely_rows(df: DataFrame, ids: DataFrame, id_col="doc_id") -> DataFrame:
    """The rows whose id is among `ids`, and a few others: for fetching texts by a join, so that only wanted ones are shuffled."""
    return _marked(df, ids, id_col).where("__likely").drop("__likely")


def rows_without(df: DataFrame, ids: DataFrame, id_col="doc_id") -> DataFrame:
    """The rows whose id is not among `ids`; a null id never is. Only rows that may be among them are shuffled."""
    marked = _marked(df, ids, id_col)
    unsure = marked.where("__likely").drop("__likely")
    name = ids.columns[0]
    left = unsure.join(own_shuffle(ids.select(F.col(name).alias("__id"))), unsure[id_col].cast("long") == F.col("__id"), "left_anti")
    return marked.where("NOT __likely").drop("__likely").unionByName(left)


def texts_of(batch, name="text"):
    return batch.column(name).to_pylist()


def span_list(spans):
    """array<struct<kind, start, end, ..>> as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def registry():
    """Queries and SQL of a module: two dicts and the decorator that files a query under its function's name."""
    queries, sql = {}, {}

    def query(text=None):
        def file(fn):
            queries[fn.__name__] = fn
            if text is not None:
                sql[fn.__name__] = text
            return fn
        return file
    return queries, sql, query
