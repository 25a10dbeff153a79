"""What the plans have to look like to hold at scale."""

import contextlib
import os
import subprocess
import sys

from pyspark.sql import functions as F

from courtledger import catalog
from courtledger.operators import matching, reshape
from courtledger.operators.history import scd2_build
from courtledger.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def run_plan(df):
    """The plan after it has run, as AQE left it. collect() would run a plan of its own."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    return execution.executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SKEW = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
        "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20k", "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
        "spark__sql__adaptive__coalescePartitions__enabled": "false", "spark__sql__shuffle__partitions": "8"}


def hot(spark):
    """One key has half of the rows."""
    return spark.range(0, 60000, numPartitions=8).select(
        "id", F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


def test_hot_key_is_split_in_membership_joins(spark):
    left = hot(spark)
    known = left.select("k").filter("k % 3 = 0")
    with settings(spark, **SKEW):
        for op in (matching.keep_members, matching.drop_members):
            assert "skew=true" in run_plan(op(left, known, ["k"])), op
        dim = spark.range(0, 60000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        assert "skew=true" in run_plan(matching.drop_members(left, dim, ["k"], unique=True))
        assert "skew=true" in run_plan(matching.resolve_key(left, dim, ["k"], "v"))
        assert "skew=true" in run_plan(matching.update_from(left.withColumn("v", F.lit(0)), dim, ["k"], ["v"], ["v"]))
        assert "skew=true" in run_plan(matching.exclude_marginal(left, known, {"id": "k", "k": "k"}))
        assert "skew=true" in run_plan(matching.all_duplicates(left, ["k"]))


def test_groups_are_reduced_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    latest = plan(matching.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert "Window" not in latest and "partial_max_by" in latest
    footer = plan(reshape.drop_footer(spark.read.parquet(f"{SF}/conversations.parquet"), ["conv_id"], ["turn"]))
    assert "Window" not in footer and "partial_max" in footer
    spells = plan(scd2_build(orders.withColumn("day", F.to_date("o_orderdate")), "o_custkey", "o_orderstatus", "day", "s", "e", ["o_orderkey"]))
    assert "partial_max_by" in spells and spells.count("Exchange") == 2   # one per (key, day), one per key for days only


def test_columns_and_filters_reach_the_scan(spark):
    df = read_table(spark, f"{SF}/orders.parquet", ["o_orderkey"], F.col("o_orderstatus") == "P")
    text = plan(df)
    assert "EqualTo(o_orderstatus,P)" in text and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in text
    for name in ("null_where", "weighted_score", "melt_measures", "parse_minutes", "period_rows"):
        text = plan(catalog.all_queries()[name](spark, SF))
        assert "Exchange" not in text and "Python" not in text, name


def test_workers_do_not_need_the_package(tmp_path):
    script = ("import sys; sys.path.insert(0, %r)\n"
              "from courtledger.session import build_session\nfrom courtledger.sources.html import extract_html_tables\n"
              "spark = build_session('local[1]', **{'spark.ui.enabled': 'false'})\n"
              "df = spark.createDataFrame([(1, '<table><tr><td>a</td></tr></table>')], 'i int, html string')\n"
              "print('cells', extract_html_tables(df, 'i').first()['cells'])\n") % os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert "cells ['a']" in done.stdout, done.stderr[-2000:]
