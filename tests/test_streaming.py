import datetime
import random

import pytest
from pyspark.sql import functions as F, types as T

from courtledger.operators.history import scd2_build
from courtledger.sources.tables import version_path
from courtledger.streaming.ingest import (DAY_STATES, day_step, dedup_stream, ingest_stream, log_path, read_days, read_log,
                                          read_state, spell_step)
from courtledger.schemas import STORED
from courtledger.streaming import ingest
from courtledger.streaming.ingest import run_batch
from tests.test_plans import KINDS, check_final, check_injuries, first_day, injuries_of_day, second_day

D = datetime.date
SPELLS = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("team", T.StringType()),
                       T.StructField("start", T.DateType()), T.StructField("end", T.DateType())])


def test_several_batches_and_a_repeated_one(spark, rows, tmp_path):
    rng = random.Random(3)
    history = [(k, D(2021, 1, d), rng.choice("AB")) for d in range(1, 13) for k in range(5) if rng.random() < 0.8]
    source, root, args = str(tmp_path / "in"), str(tmp_path / "tables"), ("k", "team", "day", "start", "end")
    step = spell_step(*args)

    def load(first, last):
        part = [r for r in history if first <= r[1].day <= last]
        rng.shuffle(part)
        spark.createDataFrame(part, "k int, day date, team string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("k int, day date, team string").parquet(source)
        query = ingest_stream(stream, root, {"open_spells": SPELLS}, step, str(tmp_path / "checkpoint"))
        query.awaitTermination()

    for first, last in ((1, 4), (5, 5), (6, 12)):   # a batch may hold many days, in any order
        load(first, last)

    def result():
        return (read_state(spark, root, {"open_spells": SPELLS})["open_spells"]
                .unionByName(read_log(spark, root, "closed_spells", SPELLS)))
    expected = rows(scd2_build(spark.createDataFrame(history, "k int, day date, team string"), *args), "k", "team", "start", "end")
    assert rows(result(), "k", "team", "start", "end") == expected

    # Repeating the last batch by hand, as after a failure, changes nothing.
    batch = spark.createDataFrame([r for r in history if r[1].day >= 6], "k int, day date, team string")
    before = spark.read.schema(SPELLS).parquet(version_path(f"{root}/open_spells", 1))
    state, logs = step(batch, {"open_spells": before}, 2)
    logs["closed_spells"].write.mode("overwrite").parquet(log_path(root, "closed_spells", 2))
    state["open_spells"].write.mode("overwrite").parquet(version_path(f"{root}/open_spells", 2))
    assert rows(result(), "k", "team", "start", "end") == expected
    assert read_log(spark, root, "closed_spells", SPELLS, before=0).count() == 0


def test_pages_arriving_day_by_day(spark, rows, tmp_path):
    """A day per batch, and the first day once more with the second."""
    source, root = str(tmp_path / "in"), str(tmp_path / "tables")
    for pages in (first_day(spark), second_day(spark).unionByName(first_day(spark))):
        pages.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(pages.schema).parquet(source)
        ingest_stream(stream, root, DAY_STATES, day_step(root), str(tmp_path / "checkpoint")).awaitTermination()
    check_final(read_days(spark, root), rows)


def test_days_as_batches_with_an_injury_list(spark, tmp_path):
    """The list comes with the second day, whose batch is run twice, as after a failure."""
    root, kinds = str(tmp_path), spark.createDataFrame(KINDS, STORED["enum_type_blessure"])
    step = day_step(root, injury_list=lambda batch_id: injuries_of_day(spark, kinds) if batch_id == 1 else None, kinds=kinds)
    for batch_id, pages in ((0, first_day(spark)), (1, second_day(spark)), (1, second_day(spark))):
        run_batch(pages, batch_id, root, DAY_STATES, step)
    check_injuries(read_days(spark, root))


def test_repeated_games_in_a_stream(spark, tmp_path):
    games = [(D(2021, 1, 1), "BOS", "PHI"), (D(2021, 1, 1), "BOS", "PHI"), (D(2021, 1, 2), "BOS", "PHI")]
    spark.createDataFrame(games, "day date, home string, away string").write.parquet(str(tmp_path / "in"))
    stream = (spark.readStream.schema("day date, home string, away string").parquet(str(tmp_path / "in"))
              .withColumn("at", F.col("day").cast("timestamp")))
    query = (dedup_stream(stream, ["day", "home", "away"], "at", "3 days").writeStream.format("memory").queryName("games")
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("games").count() == 2


def test_readers_never_see_half_a_batch(spark, rows, tmp_path, monkeypatch):
    """A batch that stops between its logs and its state leaves both as they were; run again, it counts once."""
    root, args = str(tmp_path), ("k", "team", "day", "start", "end")
    step = spell_step(*args)
    days = lambda rows: spark.createDataFrame(rows, "k int, day date, team string")
    read = lambda: rows(read_state(spark, root, {"open_spells": SPELLS})["open_spells"].unionByName(read_log(spark, root, "closed_spells", SPELLS)),
                        "k", "team", "start", "end")
    first, second = [(1, D(2021, 1, 1), "A")], [(1, D(2021, 1, 5), "B")]
    run_batch(days(first), 0, root, {"open_spells": SPELLS}, step)
    before = read()
    written = ingest.version_path

    def stop(path, version):
        raise RuntimeError("stopped before the state was written")
    monkeypatch.setattr(ingest, "version_path", stop)
    with pytest.raises(RuntimeError):
        run_batch(days(second), 1, root, {"open_spells": SPELLS}, step)
    assert read() == before == [(1, "A", D(2021, 1, 1), None)]
    monkeypatch.setattr(ingest, "version_path", written)
    for _ in range(2):
        run_batch(days(second), 1, root, {"open_spells": SPELLS}, step)
        assert read() == [(1, "A", D(2021, 1, 1), D(2021, 1, 4)), (1, "B", D(2021, 1, 5), None)]
    run_batch(days([(1, D(2021, 1, 6), "B")]), 2, root, {"open_spells": SPELLS}, step)
    assert sorted(p.name for p in (tmp_path / "open_spells").iterdir()) == ["v=1", "v=2"]


def test_rejects_are_stored(spark, rows, tmp_path):
    """A page without rows, a game of one team and a row that cannot be read are in the stored tables."""
    root = str(tmp_path)
    pages = first_day(spark).unionByName(spark.createDataFrame(
        [(D(2021, 1, 5), 8, "summary", "<table><tr><td>BOS<td>1<td>2<td>3<td>4<td>10</table>"), (D(2021, 1, 5), 9, "box", "<table><tr></table>")],
        first_day(spark).schema))
    run_batch(pages, 0, root, DAY_STATES, day_step(root))
    tables = read_days(spark, root)
    assert rows(tables["rejected_pages"], "game_no", "kind") == [(9, "box")]
    assert (8, "1 teams") in rows(tables["rejected_games"], "game_no", "reason")
