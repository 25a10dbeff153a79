"""Statistics merged from batches, contract decisions, and rows accounted for."""

import datetime
import os
import random

from pyspark.sql import functions as F

from courtledger.operators.history import decide
from courtledger.operators.rollup import finished, fold_parts, grouping_sets, partial_stats, read_parts, store_parts
from courtledger.plans import day, injuries
from courtledger.schemas import STORED
from courtledger.sources.day_folders import rejected_sheets
from courtledger.streaming.ingest import DAY_STATES, day_step, read_days, run_batch
from tests.test_plans import KINDS, check_injuries, first_day, second_day

D = datetime.date


def test_batches_merge_to_the_whole(spark, rows, tmp_path):
    rng, path = random.Random(1), str(tmp_path)
    facts = [(rng.choice("AB"), rng.choice(["x", "y", None]), rng.choice([None, *range(10)]), rng.randrange(30)) for _ in range(600)]
    frame = lambda part: spark.createDataFrame(part, "team string, season string, points int, player int")
    of = lambda df: partial_stats(df, ["team", "season"], ["points"], ["player"])
    schema = of(frame([])).schema
    for n in range(6):
        for _ in range(1 + n % 2):  # some batches twice
            store_parts(of(frame(facts[n::6])), path, n)
        fold_parts(spark, path, schema, n, every=3)
    assert sorted(os.listdir(f"{path}/base")) == ["v=2", "v=5"]
    read = lambda parts: rows(finished(grouping_sets(parts, [["team", "season"], ["team"], []]), ["points"], ["player"]).select(
        "team", "season", "sets", "n", "n_points", "sum_points", "min_points", "max_points", F.round("mean_points", 9), F.round("deviation_points", 9), "about_player"))
    got = read(read_parts(spark, path, schema))
    assert got == read(of(frame(facts)))
    everything = next(r for r in got if r[2] == "")
    points = [f[2] for f in facts if f[2] is not None]
    mean = sum(points) / len(points)
    assert everything[3:8] == (600, len(points), sum(points), 0, 9) and abs(everything[8] - mean) < 1e-6 and everything[10] == 30
    assert abs(everything[9] ** 2 - sum((p - mean) ** 2 for p in points) / (len(points) - 1)) < 1e-6
    # A season that is null is a group of its own, and not the sum over seasons.
    assert {r[2] for r in got if r[1] is None and r[0] == "A"} == {"team,season", "team"}
    assert read_parts(spark, f"{path}/none", schema).count() == 0


def test_decisions(spark, rows):
    spells = spark.createDataFrame([(1, "A", D(2024, 1, 1), None), (2, "A", D(2024, 1, 1), None), (3, "A", D(2024, 1, 1), D(2024, 1, 5)),
                                    (4, "A", D(2024, 1, 1), D(2024, 1, 5)), (4, "B", D(2024, 1, 6), None), (5, "A", D(2024, 2, 1), None), (6, "A", D(2024, 1, 1), D(2024, 1, 10))],
                                   "k int, team string, start date, end date")
    days = spark.createDataFrame([(k, D(2024, 1, 10), "A") for k in range(1, 8)] + [(2, D(2024, 1, 11), "B"), (3, D(2024, 1, 3), "B")], "k int, day date, team string")
    found = {(k, d.day): rest for k, d, _, *rest in rows(decide(spells, days, "k", "team", "day", "start", "end"))}
    nine = D(2024, 1, 9)
    assert found == {(1, 10): ["same", "A", None, None], (2, 10): ["same", "A", None, None], (3, 10): ["return", "A", None, "guaranteed"],
                     (4, 10): ["change", "B", nine, "guaranteed"], (5, 10): ["new", None, None, None], (6, 10): ["same", "A", None, None], (7, 10): ["new", None, None, None],
                     (2, 11): ["change", "A", D(2024, 1, 10), "guaranteed"], (3, 3): ["change", "A", D(2024, 1, 2), "guaranteed"]}
    assert decide(spells.limit(0), days, "k", "team", "day", "start", "end").filter("decision <> 'new'").count() == 0


def listed(spark, kinds):
    raw = spark.createDataFrame([
        ("B. Bee Bo Bee", "Fri, Jan 8", "Knee"), ("E. Eel Ed Eel", "Wed, Jan 6", "ANKLE"), ("D. Dog Di Dog", "Thu, Jan 7", "Ankle"), ("Z. Zoo Zi Zoo", "Thu, Jan 7", "Ankle"),
        ("A. Ant Al Ant", "Sat, Jan 9", "Ankle"), ("F. Fly Fo Fly", "Fri, Jan 8", "Flu"), (None, "Fri, Jan 8", "Knee"), ("G. Gnu Gu Gnu", "soon", "Knee"), ("H. Hen Ha Hen", None, None)],
        "Player string, Updated string, Injury string")
    return raw, injuries.tag_injuries(raw, kinds, D(2021, 1, 10), "2021-01-08")


def test_rows_in_are_rows_out_and_rejects(spark, rows):
    kinds = spark.createDataFrame([*KINDS, (1, "again", "ANKLE")], STORED["enum_type_blessure"])
    raw, tagged = listed(spark, kinds)
    assert tagged.count() == raw.count() == injuries.accepted(tagged).count() + injuries.rejected(tagged).count()
    normal = injuries.normalize_injury_list(raw.filter("Player IS NOT NULL"), spark.createDataFrame(KINDS, STORED["enum_type_blessure"]), D(2021, 1, 10), "2021-01-08")
    columns = ("nom_simple", "id_type_blessure", "date_blessure", "Injury")
    assert rows(injuries.accepted(tagged), *columns) == rows(normal, *columns)
    assert rows(injuries.rejected(tagged), "Player", "reason") == [("A. Ant Al Ant", "later"), ("F. Fly Fo Fly", "injury"), ("G. Gnu Gu Gnu", "date"), ("H. Hen Ha Hen", "date"), (None, "name")]


def test_an_import_stores_what_it_rejects(spark, rows, tmp_path):
    root, kinds = str(tmp_path), spark.createDataFrame(KINDS, STORED["enum_type_blessure"])
    step = day_step(root, injury_list=lambda n: listed(spark, kinds)[1] if n == 1 else None, kinds=kinds)
    for n, pages in ((0, first_day(spark)), (1, second_day(spark))):
        run_batch(pages, n, root, DAY_STATES, step)
    tables = read_days(spark, root)
    check_injuries(tables)
    assert [r[0] for r in rows(tables["rejected_injuries"], "reason")] == ["date", "date", "injury", "later", "name"]


def test_sheets_without_a_day(spark, rows):
    sheets = spark.createDataFrame([("/d/2020-12-22/m1_2020-12-22.csv", "a"), ("/d/2020-13-41/m1_2020-13-41.csv", "a"), ("/d/other.csv", "a")], "path string, value string")
    assert rows(rejected_sheets(sheets), "path") == [("/d/2020-13-41/m1_2020-13-41.csv",), ("/d/other.csv",)]
