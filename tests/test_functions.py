import datetime

import pytest
from pyspark.sql import functions as F

from courtledger.functions import temporal, text

D = datetime.date


def values(spark, inputs, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("x")).collect()]


def check(spark, expression, cases):
    assert values(spark, list(cases), expression) == list(cases.values())


def test_normalize_name(spark):
    check(spark, text.normalize_name, {"P.J. O'Neal-Smith": "pjonealsmith", "Nikola Jokić": "nikolajokić", "": ""})


def test_name_tail(spark):
    check(spark, text.name_tail, {
        "L. James LeBron James": "LeBron James",
        "T. Hardaway Jr. Tim Hardaway Jr.": "Tim Hardaway Jr.",
        "X. Y III": "X. Y III",
        "a b c d e f": "d e f",                  # five spaces: three words
        "a  b c": "b c",
        "Nene": "Nene", "": None})


def test_undouble_name(spark):
    check(spark, text.undouble_name, {
        "LeBron JamesLJ": "LeBron James", "Tim Hardaway Jr.TH": "Tim Hardaw", "Tim Hardaway TH Jr.": "Tim Hardaway ",
        "Luc Mbah a MouteLM": "Luc Mbah ", "Nene": None, "a b": "a "})


def test_slug_and_links(spark):
    slug = "https://x/game/phi-vs-bos-0022200001"
    check(spark, lambda c: text.slug_team(c, "away"), {slug: "PHI"})
    check(spark, lambda c: text.slug_team(c, "home"), {slug: "BOS"})
    url = "https://www.example.com/player/1630173/precious-achiuwa"
    check(spark, text.url_basename, {url: "precious-achiuwa", url + "/": ""})
    check(spark, text.url_parent, {url: "1630173", url + "/": "1630173", "https://e.com/a": None})


def test_profile_texts(spark):
    check(spark, text.height_m, {"6'8\" (2.03m)": 2.03, "(3.00m)": None, "": None})
    check(spark, text.weight_kg, {"250lb (113kg)": 113.0, "(1134kg)": None, "-": None})
    check(spark, text.position_code, {"Team | #4 | Guard-Forward": "G-F", "Center": "C", "a | Coach": "NC", "Guard-x": "G-NC"})
    check(spark, lambda c: text.pad_left(c, 2), {"7": "07", "123": "123"})
    check(spark, lambda c: text.count_char(c, "a"), {"banana": 3, "": 0})
    assert values(spark, ["x"], lambda c: text.contains_any(c, ["a", "x"])) == [True]
    assert values(spark, ["X"], lambda c: text.contains_any(c, ["a", "x"])) == [False]


def test_parse_minutes_and_back(spark):
    cases = {"36:13": "00:36:13", "36.000000:13": "00:36:13", "5:07": "00:05:07", "12.30": "00:12:30", "75:00": "01:15:00",
             "DNP": "", "12": "", None: ""}
    check(spark, lambda c: temporal.format_duration(temporal.parse_minutes(c)), cases)
    assert values(spark, ["36:13", None], lambda c: temporal.interval_seconds(temporal.parse_minutes(c))) == [2173, None]


def test_duration_leaves_out_days(spark):
    df = spark.sql("SELECT make_dt_interval(2, 3, 4, 5) AS d")
    assert df.select(temporal.format_duration("d")).first()[0] == "03:04:05"


def test_did_not_play(spark):
    check(spark, temporal.is_dnp, {
        "DNP - Coach's Decision": True, "Pas en tenue": True, "dnp": None, "0": True, "0:00": True, "0.000000:00": True,
        "36:13": False, "36.000000:13": False, "0.000000:01": False, "what": None, None: False})
    check(spark, temporal.is_injured, {"DNP - Injury/Illness": True, "DNP": False, None: False})


def test_infer_year(spark):
    ref = datetime.datetime(2023, 3, 4, 12)
    check(spark, lambda c: temporal.infer_year(c, ref), {
        "Sat, Mar 4": D(2023, 3, 4), "Sun, Mar 5": D(2022, 3, 5), "Tue, Dec 27": D(2022, 12, 27),
        "Tue, Feb 29": None, "none": None})


def test_dates(spark):
    check(spark, lambda c: temporal.entry_date(c, 2021), {"Rookie": D(2021, 10, 1), "3 Years": D(2018, 10, 1), "-": None})
    day = lambda f: lambda c: f(F.to_date(c))
    check(spark, day(temporal.day_before), {"2021-03-01": D(2021, 2, 28)})
    check(spark, day(temporal.day_after), {"2020-02-28": D(2020, 2, 29)})
    check(spark, lambda c: temporal.days_to_import(F.to_date(c), D(2021, 3, 1)), {"2021-02-27": 2, "2021-03-02": -1})
    check(spark, day(temporal.iso_date), {"2021-02-03": "2021-02-03"})


@pytest.mark.parametrize("base", ["https://x/games"])
def test_dated_url(spark, base):
    check(spark, lambda c: text.dated_url(base, F.to_date(c)), {"2021-02-03": base + "?date=2021-02-03"})
