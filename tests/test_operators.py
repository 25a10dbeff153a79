import datetime
import random

import pytest
from pyspark.sql import functions as F

from courtledger import fixed_values as fv
from courtledger.operators import history, keys, matching, reshape

D = datetime.date


def test_periods_by_width(spark, rows):
    df = spark.createDataFrame([(1, [1, 2, 3, 4, 10]), (2, [1, 2, 3, 4, 5, 15]), (3, [1, 2, 3, 4, 5, 6, 21]), (4, [1, 2]),
                                (5, [1, 2, 3, 4, 5, 6, 7, 8, 36])], "g int, v array<int>")
    out = {r["g"]: r["p"] for r in df.select("g", reshape.period_map("v").alias("p")).collect()}
    assert out[1] == {"q1": 1, "q2": 2, "q3": 3, "q4": 4, "final": 10}
    assert out[3] == {"q1": 1, "q2": 2, "q3": 3, "q4": 4, "pr1": 5, "pr2": 6, "final": 21}
    assert out[4] is None and out[5]["pr4"] == 8 and out[5]["final"] == 36
    melted = reshape.melt_map(df.filter("g = 2").select("g", reshape.period_map("v").alias("p")), ["g"], "p", "period", "points")
    assert ("pr1", 5) in rows(melted, "period", "points") and melted.count() == 6


def test_footer_and_head(spark, rows):
    df = spark.createDataFrame([("a", i, f"n{i}x") for i in range(3)] + [("b", 0, "zx")], "g string, i int, n string")
    assert rows(reshape.drop_footer(df, ["g"], ["i"]), "g", "i") == [("a", 0), ("a", 1)]
    assert rows(reshape.drop_footer(df, [], ["g", "i"]), "g", "i") == [("a", 0), ("a", 1), ("a", 2)]
    assert rows(reshape.edit_head(df, "n", "i", 1, reshape.drop_last_char), "n") == [("n0",), ("n1x",), ("n2x",), ("z",)]


def test_null_cast_score(spark):
    df = spark.createDataFrame([("a", "1", "2", True), ("b", "1.5", "x", False), ("c", None, "3", None)], "k string, p string, q string, out boolean")
    nulled = {r["k"]: r for r in reshape.null_where(df, F.col("out"), keep=["k", "out"]).collect()}
    assert nulled["a"]["p"] is None and nulled["b"]["p"] == "1.5" and nulled["c"]["q"] == "3"
    cast = {r["k"]: r for r in reshape.cast_measures(df, keep=["k", "out"]).collect()}
    assert cast["b"]["p"] == 1.5 and cast["b"]["q"] is None and cast["b"]["rejected"] == ["q"] and cast["c"]["rejected"] == []


def test_score_takes_misses_off(spark):
    row = dict(points=28.0, rebonds=4.0, passes_dec=7.0, steal=1.0, contres=0.0, tir_reussi=11.0, tir_tentes=18.0, trois_pt_r=4.0,
               trois_pt_t=8.0, lanc_frc_r=2.0, lanc_frc_t=2.0, ball_perdu=3.0)
    df = spark.createDataFrame([tuple(row.values())], list(row))
    score = reshape.linear_score(fv.SCORE_GAINS, fv.SCORE_LOSSES, fv.SCORE_MADE_ATTEMPTED)
    assert df.select(score).first()[0] == 57 - (3 + 7 + 4 + 0)
    assert df.select(reshape.linear_score(["points"], when=F.lit(False))).first()[0] is None


def test_union_pivot_melt_rename(spark, rows):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("y", 2.0)], "s string, d double")
    assert rows(reshape.union_by_name([a, b]), "i", "s", "d") == [(1, "x", None), (None, "y", 2.0)]
    assert reshape.union_by_name([], empty=a.limit(0)).count() == 0
    with pytest.raises(ValueError):
        reshape.union_by_name([])
    with pytest.raises(ValueError):
        reshape.rename_by_position(a, ["one"])
    pair = spark.createDataFrame([(1, 0, "BOS"), (1, 1, "PHI"), (2, 0, "LAL")], "g int, i int, t string")
    assert rows(reshape.pivot_pair(pair, ["g"], "i", "t", ["away", "home"])) == [(1, "BOS", "PHI"), (2, "LAL", None)]
    assert rows(reshape.melt(spark.createDataFrame([("t", 1, 2)], "t string, q1 int, q2 int"), ["t"])) == [("t", "q1", 1), ("t", "q2", 2)]
    cells = spark.createDataFrame([(["a", "b"],)], "cells array<string>")
    assert rows(reshape.cells_to_columns(cells, ["x", "y", "z"])) == [("a", "b", None)]


def test_marginal_is_not_pairwise(spark, rows):
    new = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c"), (1, None), (None, "a")], "d int, p string")
    known = spark.createDataFrame([(1, "b"), (2, "a")], "d int, p string")
    kept = matching.exclude_marginal(new, known, {"d": "d", "p": "p"})
    assert rows(kept, "d", "p") == [(1, None), (3, "c"), (None, "a")]
    assert rows(matching.drop_members(new, known, ["d", "p"])) == [(1, "a"), (1, None), (3, "c"), (None, "a")]
    assert rows(matching.keep_members(new, known, ["d", "p"])) == [(1, "b"), (2, "a")]
    for options in ({"unique": True}, {"hot": False}):
        assert rows(matching.keep_members(new, known, ["d", "p"], **options)) == [(1, "b"), (2, "a")]


def test_nulls_do_not_empty_an_exclusion(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(matching.drop_members(left, right, ["k"])) == [(2,), (None,)]


def test_duplicates_update_resolve_latest(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "i int, k string")
    assert rows(matching.all_duplicates(df, ["k"]), "i") == [(1,), (2,), (4,), (5,)]
    source = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("z", "no", 1)], "k string, v string, o int")
    target = df.withColumn("v", F.lit("kept"))
    assert rows(matching.update_from(target, source, ["k"], ["v"], ["o"]), "i", "v") == [
        (1, "new"), (2, "new"), (3, "kept"), (4, "kept"), (5, "kept")]
    nulls = spark.createDataFrame([("a", None, 1)], "k string, v string, o int")
    assert rows(matching.update_from(target.filter("i = 1"), nulls, ["k"], ["v"], ["o"]), "v") == [(None,)]
    dim = spark.createDataFrame([("a", 10), ("a", 11)], "k string, id int")
    assert rows(matching.resolve_key(df, dim, ["k"], "id"), "i", "id") == [(1, 10), (1, 11), (2, 10), (2, 11), (3, None), (4, None), (5, None)]
    assert rows(matching.unknown_members(df, dim, ["k"], ["i"])) == [(3,), (4,), (5,)]
    assert rows(matching.latest_per_key(df, ["k"], ["i"]), "k", "i") == [("a", 2), ("b", 3), (None, 5)]
    groups = matching.invert({"east": ["BOS", "PHI"], "west": ["LAL"]})
    teams = spark.createDataFrame([("LAL",), ("XXX",)], "t string")
    assert rows(teams.select(matching.lookup("t", groups))) == [("west",), (None,)]


def test_ids_are_dense_and_ordered(spark, rows):
    n = 5000
    df = spark.range(n, numPartitions=7).select((F.lit(n) - F.col("id")).alias("k"), F.lit("same").alias("hot"))
    out = keys.allocate_ids(df, "new_id", ["hot", "k"], after=100)
    assert [tuple(r) for r in out.orderBy("new_id").select("new_id", "k").collect()] == [(101 + i, 1 + i) for i in range(n)]
    assert keys.allocate_ids(df.limit(0), "new_id", ["k"]).count() == 0


def test_new_members(spark, rows):
    dim = spark.createDataFrame([(7, "A", "a")], "id long, nom string, simple string")
    facts = spark.createDataFrame([("A", "a"), ("C", "c"), ("B", "b"), ("b", "b"), ("N", None)], "nom string, simple string")
    out = keys.add_members(dim, facts, ["simple"], ["nom", "simple"], "id", 7)
    assert rows(out, "id", "nom", "simple") == [(7, "A", "a"), (8, "b", "b"), (9, "C", "c")]
    assert rows(keys.add_members(dim.select("id", "simple"), facts, ["simple"], ["simple"], "id", 7), "id", "simple") == [
        (7, "a"), (8, "b"), (9, "c")]


SPELL = "id long, k int, team string, start date, end date"


def test_changes_close_and_reopen(spark, rows):
    spells = spark.createDataFrame([
        (1, 1, "BOS", D(2021, 1, 1), None),          # goes on, then changes
        (2, 2, "BOS", D(2021, 1, 1), None), (3, 2, "LAL", D(2021, 1, 2), None),  # two stale ones
        (4, 3, "PHI", D(2020, 1, 1), D(2020, 5, 1)),  # past
        (5, 4, "PHI", D(2021, 1, 1), None),          # not in the batch
        (6, 5, "BOS", D(2021, 1, 1), None), (7, 5, "LAL", D(2021, 1, 1), None)], SPELL)  # one stale, one equal
    batch = spark.createDataFrame([
        (1, "BOS", D(2021, 2, 1), 1), (1, "PHI", D(2021, 2, 5), 1), (2, "PHI", D(2021, 2, 1), 1),
        (3, "BOS", D(2021, 2, 1), 1), (5, "LAL", D(2021, 2, 1), 1), (6, "BOS", D(2021, 2, 1), 1), (6, "LAL", D(2021, 2, 1), 2),
        (None, "BOS", D(2021, 2, 1), 1)], "k int, team string, day date, o int")
    change = history.scd2_apply(spells, batch, "k", "team", "day", "start", "end", ["o"])
    assert rows(change.all(), "id", "k", "team", "start", "end") == sorted([
        (1, 1, "BOS", D(2021, 1, 1), D(2021, 2, 4)), (None, 1, "PHI", D(2021, 2, 5), None),
        (2, 2, "BOS", D(2021, 1, 1), D(2021, 1, 31)), (3, 2, "LAL", D(2021, 1, 2), D(2021, 1, 31)), (None, 2, "PHI", D(2021, 2, 1), None),
        (4, 3, "PHI", D(2020, 1, 1), D(2020, 5, 1)), (None, 3, "BOS", D(2021, 2, 1), None),
        (5, 4, "PHI", D(2021, 1, 1), None),
        (6, 5, "BOS", D(2021, 1, 1), D(2021, 1, 31)), (7, 5, "LAL", D(2021, 1, 1), None),
        (None, 6, "LAL", D(2021, 2, 1), None)], key=str)
    assert change.closed().count() == 4 and change.opened.count() == 4


def test_events_open_and_close(spark, rows):
    spells = spark.createDataFrame([
        (1, 1, 3, D(2021, 1, 1), None), (2, 1, 99, D(2021, 1, 5), None),  # both close, whatever their kind
        (3, 2, 3, D(2021, 1, 1), None),                                  # still hurt, later back
        (4, 4, 3, D(2021, 1, 1), None)], "id long, k int, kind int, start date, end date")
    batch = spark.createDataFrame([
        (1, False, D(2021, 2, 1)), (2, True, D(2021, 2, 1)), (2, False, D(2021, 2, 3)), (2, True, D(2021, 2, 5)),
        (3, True, D(2021, 2, 1)), (5, False, D(2021, 2, 1))], "k int, hurt boolean, day date")
    out = history.event_spells_apply(spells, batch, "k", "hurt", "day", "start", "end", {"kind": 99}).all()
    assert rows(out, "id", "k", "kind", "start", "end") == sorted([
        (1, 1, 3, D(2021, 1, 1), D(2021, 1, 31)), (2, 1, 99, D(2021, 1, 5), D(2021, 1, 31)),
        (3, 2, 3, D(2021, 1, 1), D(2021, 2, 2)), (None, 2, 99, D(2021, 2, 5), None),
        (4, 4, 3, D(2021, 1, 1), None), (None, 3, 99, D(2021, 2, 1), None)], key=str)


def fold(history_rows):
    """Spells by going through the days one after the other, as plain Python."""
    out, current = [], {}
    for key, day, attr in sorted(history_rows, key=lambda r: (r[1], r[0])):
        if key in current and current[key][1] != attr:
            out.append((key, current[key][1], current[key][0], day - datetime.timedelta(1)))
            del current[key]
        current.setdefault(key, (day, attr))
    return sorted(out + [(k, a, s, None) for k, (s, a) in current.items()], key=str)


@pytest.mark.parametrize("seed", range(2))
def test_day_by_day_and_bulk_agree(spark, rows, seed):
    rng = random.Random(seed)
    history_rows = [(k, D(2021, 1, d), rng.choice("AB")) for k in range(6) for d in range(1, 13) if rng.random() < 0.7]
    df = spark.createDataFrame(history_rows, "k int, day date, team string")
    expected = fold(history_rows)
    args = ("k", "team", "day", "start", "end")
    assert rows(history.scd2_build(df, *args), "k", "team", "start", "end") == expected
    state = spark.createDataFrame([], "k int, team string, start date, end date")
    for first, last in ((1, 1), (2, 5), (6, 12)):
        batch = df.filter(F.dayofmonth("day").between(first, last))
        state = history.scd2_apply(state, batch, *args).all()
        state = spark.createDataFrame(state.collect(), state.schema)
    assert rows(state, "k", "team", "start", "end") == expected
