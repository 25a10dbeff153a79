from pyspark.sql import functions as F


def registry():
    """Two dicts and a decorator that files a query and its SQL under the function's name."""
    queries, sql = {}, {}

    def query(text=None):
        def file(fn):
            queries[fn.__name__] = fn
            if text is not None:
                sql[fn.__name__] = text
            return fn
        return file
    return queries, sql, query


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def date(column):
    return F.col(column).cast("date")


def spread(df, key):
    """Slim rows over all tasks, before they are turned into something large."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
