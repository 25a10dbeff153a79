"""Days in any order of arrival: spells, keyed state, and the day import."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from courtledger.operators.history import event_spells_build, event_spells_correct, observed_days, scd2_build, scd2_correct
from courtledger.schemas import STORED
from courtledger.session import cut_lineage
from courtledger.streaming import keyed
from courtledger.streaming.ingest import DAY_STATES, Parted, any_order_step, day_step, ingest_stream, read_days, read_log, read_state, run_batch, spell_state
from courtledger.streaming.keyed import Keyed, changes, fold, read_keyed, write_changes
from tests.test_plans import check_final, first_day, second_day

D = datetime.date
ARGS = ("k", "team", "day", "start", "end")
SPELLS = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("team", T.StringType()), T.StructField("start", T.DateType()), T.StructField("end", T.DateType())])


def history(seed, n=20):
    rng = random.Random(seed)
    rows = [(k, D(2024, 1, d), rng.choice(["A", "A", "B", None]), i) for k in range(n) for d in range(1, 25) for i in range(2) if rng.random() < 0.3]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, day date, team string, no int")


def fold_batches(spark, batches, correct, days_of, spells):
    seen = None
    for batch in batches:
        days = cut_lineage(days_of(batch))
        spells = cut_lineage(correct(spells, days.limit(0) if seen is None else seen, days).all())
        seen = days if seen is None else seen.unionByName(days)
    return spells


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_gives_the_spells_of_all_days(spark, rows, seed):
    """Batches cut anywhere, even within a day; the last one repeats the first."""
    all_rows = history(seed)
    batches = [frame(spark, all_rows[i::3]) for i in range(3)]
    batches.append(batches[0])
    days = lambda df: observed_days(df, "k", "team", "day", ["no"])
    got = fold_batches(spark, batches, lambda s, o, b: scd2_correct(s, o, b, *ARGS, ["no"], store=cut_lineage), days, spark.createDataFrame([], SPELLS))
    whole = frame(spark, all_rows)
    assert rows(got, "k", "team", "start", "end") == rows(scd2_build(whole, *ARGS, ["no"]), "k", "team", "start", "end")

    hurt = lambda df: df.select("k", "day", F.coalesce(F.col("team") == "B", F.lit(False)).alias("hurt"))
    args = ("k", "hurt", "day", "start", "end")
    empty = spark.createDataFrame([], "k int, start date, end date, kind int")
    got = fold_batches(spark, [hurt(b) for b in batches], lambda s, o, b: event_spells_correct(s, o, b, *args, {"kind": 99}, store=cut_lineage),
                       lambda df: observed_days(df, "k", "hurt", "day"), empty)
    assert rows(got, "k", "start", "end") == rows(event_spells_build(hurt(whole), *args), "k", "start", "end")
    assert {r["kind"] for r in got.collect()} == {99}


def test_a_day_before_an_open_spell(spark, rows):
    """The case that used to end a spell before it began. Other columns, such as ids, stay with the spell that goes on."""
    spells = spark.createDataFrame([(7, 1, "A", D(2024, 1, 10), None), (8, 2, "A", D(2024, 1, 1), None)], "id int, k int, team string, start date, end date")
    seen = frame(spark, [(1, D(2024, 1, 10), "A", 0), (2, D(2024, 1, 1), "A", 0), (2, D(2024, 1, 3), "A", 0), (2, D(2024, 1, 8), "A", 0)])
    late = frame(spark, [(1, D(2024, 1, 5), "B", 0), (2, D(2024, 1, 5), "B", 0)])
    change = scd2_correct(spells, seen, late, *ARGS, ["no"])
    assert rows(change.all(), "id", "k", "team", "start", "end") == sorted([
        (None, 1, "B", D(2024, 1, 5), D(2024, 1, 9)), (7, 1, "A", D(2024, 1, 10), None), (8, 2, "A", D(2024, 1, 1), D(2024, 1, 4)),
        (None, 2, "B", D(2024, 1, 5), D(2024, 1, 7)), (None, 2, "A", D(2024, 1, 8), None)], key=str)
    assert rows(change.kept, "id") == [(7,)] and change.gone.count() == 0
    early = frame(spark, [(1, D(2024, 1, 5), "A", 0)])
    change = scd2_correct(spells, seen, early, *ARGS, ["no"])
    assert rows(change.changed, "id", "start", "end") == [(7, D(2024, 1, 5), None)] and rows(change.moved, "id", "start") == [(7, D(2024, 1, 10))]
    # A day that joins two spells leaves the earlier one; a later one is gone.
    two = spark.createDataFrame([(1, 1, "A", D(2024, 1, 1), D(2024, 1, 4)), (2, 1, "B", D(2024, 1, 5), D(2024, 1, 6)), (3, 1, "A", D(2024, 1, 7), None)],
                                "id int, k int, team string, start date, end date")
    change = scd2_correct(two, frame(spark, [(1, D(2024, 1, 5), "B", 0), (1, D(2024, 1, 7), "A", 0)]), frame(spark, [(1, D(2024, 1, 5), "A", 1)]), *ARGS, ["no"])
    assert rows(change.all(), "id", "team", "start", "end") == [(1, "A", D(2024, 1, 1), None)] and rows(change.gone, "id") == [(2,), (3,)]


def test_empty_batches_and_states(spark, rows):
    none, spells = frame(spark, []), spark.createDataFrame([(1, "A", D(2024, 1, 1), None)], SPELLS)
    assert rows(scd2_correct(spells, none, none, *ARGS, ["no"]).all()) == [(1, "A", D(2024, 1, 1), None)]
    assert scd2_correct(spells.limit(0), none, none, *ARGS, ["no"]).all().count() == 0
    nobody = frame(spark, [(None, D(2024, 1, 1), "A", 0)])
    assert rows(scd2_correct(spells, none, nobody, *ARGS, ["no"]).all()) == [(1, "A", D(2024, 1, 1), None)]


KEYED = Keyed(T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())]), ("id",), sort="v")


def test_keyed_state(spark, rows, tmp_path, monkeypatch):
    """Any sequence of changes and folds reads as a dict does; repeated batches change nothing; bases come seldom."""
    monkeypatch.setattr(keyed, "LEAST_CHANGES", 6)
    rng, want, path, folds = random.Random(4), {}, str(tmp_path), []
    for batch in range(10):
        ids = rng.sample(range(12), 3)
        new = [(i, f"{i}/{batch}") for i in ids[:2]]
        gone = [(ids[2], None), (ids[0], "also replaced")]
        frames = spark.createDataFrame(new, KEYED.schema), spark.createDataFrame(gone, KEYED.schema)
        before = dict(want)
        want.update(new)
        want.pop(ids[2], None)
        for _ in range(2):
            assert rows(read_keyed(spark, path, KEYED, batch)) == sorted(before.items(), key=str)
            write_changes(changes(*frames, KEYED.key), path, KEYED, batch)
        assert rows(read_keyed(spark, path, KEYED, batch + 1)) == sorted(want.items(), key=str)
        folds.append(fold(spark, path, KEYED, batch))
        assert rows(read_keyed(spark, path, KEYED, batch + 1)) == sorted(want.items(), key=str)
        some = F.col("id") < 6
        assert rows(read_keyed(spark, path, KEYED, batch + 1, some)) == sorted(((i, v) for i, v in want.items() if i < 6), key=str)
    assert 1 < sum(folds) < 6
    assert read_keyed(spark, f"{path}/none", KEYED, 5).count() == 0


def size_of(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


def test_stream_of_days_in_any_order(spark, rows, tmp_path):
    """Several batches, a restart of the stream between them, and one batch run again; what a batch writes follows the batch."""
    all_rows, source, root = history(7, 60), str(tmp_path / "in"), str(tmp_path / "tables")
    state, step = spell_state(SPELLS, "k", "start", "end"), any_order_step(root, *ARGS, ["no"])
    parts = [all_rows[i::3] for i in range(3)] + [[(3, D(2024, 1, 2), "B", 9)]]
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame(spark, []).schema).parquet(source)
        ingest_stream(stream, root, state, step, str(tmp_path / "checkpoint")).awaitTermination()
    want = rows(scd2_build(frame(spark, sum(parts, [])), *ARGS, ["no"]), "k", "team", "start", "end")
    read = lambda: rows(read_state(spark, root, state)["spells"], "k", "team", "start", "end")
    assert read() == want
    run_batch(frame(spark, parts[-1]), len(parts) - 1, root, state, step)
    assert read() == want
    written = [spark.read.parquet(f"{root}/spells/changes/batch={k}").count() for k in range(len(parts))]
    assert written[-1] <= 4 < written[0]
    assert not os.path.exists(f"{root}/_incoming/0")


def test_logs_by_day_are_read_by_folder(spark, tmp_path):
    root, schema = str(tmp_path), T.StructType([T.StructField("day", T.DateType()), T.StructField("v", T.LongType())])
    days = spark.range(40).select(F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") % 20).cast("int")).alias("day"), F.col("id").alias("v"))
    run_batch(days, 0, root, {}, lambda batch, state, n: ({}, {"days": Parted(batch, "day")}))
    some = read_log(spark, root, "days", schema, where=F.col("day").between(F.lit("2024-01-03"), F.lit("2024-01-04")))
    filters = some._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "day#" in filters and "batch#" in filters and some.count() == 4


def test_days_imported_in_the_wrong_order(spark, rows, tmp_path):
    """The second day first: the stored tables are those of the right order, but for the ids."""
    def load(name, *batches):
        root = str(tmp_path / name)
        for n, pages in enumerate(batches):
            run_batch(pages, n, root, DAY_STATES, day_step(root))
        tables = read_days(spark, root)
        names = {r["id_joueur"]: r["nom_simple"] for r in tables["joueur"].collect()}
        named = lambda table, *columns: sorted((names[r["id_joueur"]], *[str(r[c]) for c in columns]) for r in tables[table].collect())
        assert len({r[0] for r in tables["contrat"].select("id_contrat").collect()}) == tables["contrat"].count()
        return (named("contrat", "id_equipe", "date_debut_contrat", "date_fin_contrat"), named("blessure", "id_type_blessure", "date_blessure", "date_guerison"),
                named("stats_joueur", "minute", "points"), rows(tables["match"], "date_match", "equipe_domicile")), tables
    one, two = first_day(spark), second_day(spark)
    right, tables = load("right", one, two, one)
    check_final(tables, rows)
    assert load("wrong", two, one)[0] == right == load("again", two, one, two)[0]
