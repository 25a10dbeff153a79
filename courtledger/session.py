"""Session settings, and where intermediate results may be written."""

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Intermediate tables of this driver.
_scratch = []


def build_session(master=None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName("courtledger")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot key even where that costs one more shuffle of the joined rows.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Python workers take whole pages and texts: bound a batch by its bytes, not by its rows alone.
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session. A local session without one gets its own."""
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if path is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        # (The executors of local-cluster are processes of their own, as on any cluster.)
        if configured is None and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="courtledger-"))
        path = sc.getCheckpointDir()
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table, which is removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_remove_scratch, spark, _scratch)
    _scratch.append(path)
    return path


def _remove_scratch(spark: SparkSession, paths) -> None:
    """Drop the intermediate tables of a session that ends; one that has ended already leaves them to its checkpoint folder."""
    try:
        for path in paths:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    except Exception:  # the JVM is gone
        return


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store the rows once, in the shared folder, and read them back in everything that follows.

    A table rather than a checkpoint of rows: readers take only the columns they need.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
