import pytest
from pyspark.sql import functions as F

from courtledger.sources import day_folders, html
from courtledger import schemas
from courtledger.plans.schedule import build_schedule
from courtledger.sources import day_folders, tables
from courtledger.sources.html import count_links, extract_html_tables, extract_links, pages_without_tables, read_tables


def test_tables_of_a_page():
    page = """<html><head><style>table{}</style></head><body><!-- <table><tr><td>no</td></tr></table> -->
    <TABLE><THEAD><TR><TH>A</TH><TH title="a > b">B</TH></TR></THEAD>
      <tfoot><tr><td>sum</td><td>3</td></tr></tfoot>
      <tbody><tr><td>x<br>y</td><td>1 &amp; 2</td></tr><tr><td> <b>bold</b>
      text </td></tr></tbody></TABLE>
    <table><tr><td></td></tr></table>
    <table><tr><th>only</th></tr><tr><td>in<table><tr><td>inner</td></tr></table>out</td></tr></table>
    <script>document.write("<table><tr><td>no</td></tr></table>")</script></body></html>"""
    first, second, inner = read_tables(page)
    assert first == ([["A", "B"]], [["x y", "1 & 2"], ["bold  text", None], ["sum", "3"]])
    assert second == ([["only"]], [["ininnerout"]])
    assert inner == ([], [["inner"]])


def test_spans_and_damage():
    assert read_tables("<table><tr><td colspan=2>a<td rowspan='2'>b<tr><td>c<td>d<tr><td>e</table>") == [
        ([], [["a", "a", "b"], ["c", "d", "b"], ["e", None, None]])]
    assert read_tables("<table><tr><td data=o'neal>x</td><td title='a > b'>y</td><td class=\"c>z</td></tr></table>") == [
        ([], [["x", "y", "z"]])]
    assert read_tables("<table><tr><td>a</td><td><script>s='</style><td>'</script>b</table>") == [([], [["a", "b"]])]
    assert read_tables("<table><tr><td>never closed") == [([], [["never closed"]])]
    assert read_tables("no table < here > at all") == []
    assert read_tables("<table><tr><td style='color:red; display: none'>x</td><td>y</td></tr></table>") == [([], [["y"]])]


def test_extract_keeps_ids_and_positions(spark, rows):
    pages = spark.createDataFrame([
        ("2021-01-01", 0, "<table><tr><th>h</th></tr><tr><td>a</td></tr><tr><td>b</td></tr></table>"),
        ("2021-01-01", 1, "<p>none</p>"), ("2021-01-02", 0, None)], "day string, no int, html string")
    out = extract_html_tables(pages, ["day", "no"])
    assert rows(out, "day", "no", "table_idx", "is_header", "row_idx", "n_rows", "cells") == [
        ("2021-01-01", 0, 0, False, 0, 2, ["a"]), ("2021-01-01", 0, 0, False, 1, 2, ["b"]), ("2021-01-01", 0, 0, True, 0, 1, ["h"])]
    assert rows(extract_html_tables(pages, ["day", "no"], batch_rows=1), "row_idx", "cells") == rows(out, "row_idx", "cells")
    assert rows(pages_without_tables(pages), "day", "no") == [("2021-01-01", 1), ("2021-01-02", 0)]


def test_links(spark, rows):
    pages = spark.createDataFrame([(1, '<a href="/g/phi-vs-bos-1">x</a><a class="c" href="/g/phi-vs-bos-1">y</a><a href="/other">z</a>'), (2, "")],
                                  "page int, html string")
    assert rows(count_links(pages, "page")) == [(1, 3), (2, 0)]
    games = extract_links(pages, "page", containing="-vs-")
    assert rows(games) == [(1, 0, "/g/phi-vs-bos-1"), (1, 1, "/g/phi-vs-bos-1")]
    schedule = build_schedule(extract_links(pages, "page").withColumn("day", F.lit("2021-01-01")), "day", "link", 2)
    assert [(r[0], r[1], str(r[2]), r[3]) for r in schedule.collect()] == [("PHI", "BOS", "2021-01-01", 2)]
    assert build_schedule(games.limit(0).withColumn("day", F.lit("2021-01-01")), "day", "link", 2).count() == 0


GAME = "equipe,q1,q2,q3,q4,{extra}final\r\nGSW,25,20,26,28,{values}99\r\nBKN,40,23,36,26,{values}125\r\n"
PLAYERS = ("nom,minute,points,dnp,blesse,nom_simple,score_ttfl\n"
           "P.J. Wash,0 days 00:36:13,28.0,False,False,pjwash,51.0\nAl Burks,,,True,True,alburks,\nbroken,1\n")


def test_day_folders_with_mixed_headers(spark, rows, tmp_path):
    for date, no, extra, values in (("2020-12-22", 0, "", ""), ("2020-12-23", 9, "pr1,", "7,"), ("2020-12-26", 2, "pr1,pr2,", "7,8,")):
        folder = tmp_path / date
        folder.mkdir()
        (folder / f"m{no}_{date}.csv").write_bytes(GAME.format(extra=extra, values=values).encode())
        (folder / f"m{no}_equipe1_{date}.csv").write_text(PLAYERS)
        (folder / "notes.txt").write_text("x")
    sheets = day_folders.read_day_folders(spark, str(tmp_path))
    at = lambda p: F.try_element_at("periods", F.lit(p)).alias(p)
    games = day_folders.game_rows(sheets)
    assert rows(games.filter("team_idx = 0"), F.col("game_date").cast("string"), "game_no", "id_equipe", at("q1"), at("pr1"), at("pr2"), at("final")) == [
        ("2020-12-22", 0, "GSW", 25, None, None, 99), ("2020-12-23", 9, "GSW", 25, 7, None, 99), ("2020-12-26", 2, "GSW", 25, 7, 8, 99)]
    players = day_folders.player_rows(sheets)
    assert players.count() == 6
    first = players.filter("game_no = 9 AND row_idx = 0").first()
    assert (first["nom"], first["points"], first["dnp"], first["stored_score"]) == ("P.J. Wash", 28.0, False, 51.0)
    assert str(first["minute"]) == "0:36:13" and first["faute_p"] is None
    assert sheets.filter("fields IS NULL").count() == 3


def test_append_publish_versions(spark, rows, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    tables.append_rows(df, f"{root}/t", partition_by=["s"])
    tables.append_rows(df.select("s", "i"), f"{root}/t", partition_by=["s"])
    assert spark.read.parquet(f"{root}/t").count() == 4
    with pytest.raises(ValueError):
        tables.append_rows(df.drop("s"), f"{root}/t")
    groups = {"match": {"m": df}, "stats": {"p": df}}
    assert tables.publish(groups, f"{root}/pub", ["match"]) == ["m"]
    assert tables.publish(groups, f"{root}/pub") == ["m", "p"] and spark.read.parquet(f"{root}/pub/m").count() == 4
    for bad in ("match", ["nothing"]):
        with pytest.raises(ValueError):
            tables.publish(groups, f"{root}/pub", bad)
    assert tables.latest_version(spark, f"{root}/v") == -1
    assert tables.write_version(df, f"{root}/v") == 0
    assert tables.write_version(tables.read_version(spark, f"{root}/v", 0, df.schema).union(df), f"{root}/v") == 1
    assert tables.read_version(spark, f"{root}/v", 1, df.schema).count() == 4
    (tmp_path / "v" / "v=2").mkdir()   # unfinished
    assert tables.latest_version(spark, f"{root}/v") == 1


def test_flat_files_and_schemas(spark, rows, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "a,b", None), (2, None, 1.5)], "i int, s string, d double")
    tables.write_csv(df, f"{root}/c")
    assert rows(tables.read_csv(spark, f"{root}/c", df.schema)) == rows(df)
    tables.write_json(df, f"{root}/j")
    assert rows(spark.read.schema(df.schema).json(f"{root}/j")) == rows(df)
    tables.create_tables(spark, schemas.STORED, f"{root}/db", ["joueur", "match"])
    tables.create_tables(spark, schemas.STORED, f"{root}/db", ["joueur", "match"])
    assert spark.read.parquet(f"{root}/db/match").schema == schemas.STORED["match"]
    assert [r[1] for r in tables.date_series(spark, "2020-02-28", 3).collect()] == ["2020-02-28", "2020-02-29", "2020-03-01"]
    assert tables.max_of(df, "i") == 2 and tables.max_of(df.limit(0), "i", 0) == 0
    assert tables.inline_table(spark, [(1, "x")], "i int, s string").count() == 1


@pytest.mark.parametrize("page, expected", [
    ("<table><tr style='display:none'><td>h<tr><td>a</table><table><tr><td>2</table>", [[["a"]], [["2"]]]),
    ("<ul><li style='display:none'>x</ul><table><tr><td>2</table>", [[["2"]]]),
    ("<p style='display:none'>x<table><tr><td>2</table>", [[["2"]]]),
    ("<table><tr><td>a<td style='display:none'>h<td>b<tr><td>c<td>d</table>", [[["a", "b"], ["c", "d"]]]),
    ("<table><tr><td>a<div style='display:none'>h<td>b</table>", [[["a", "b"]]]),
    ("<div style='display:none'><table><tr><td>x</table></div><table><tr><td>1</table>", [[["1"]]]),
    ("<table><tr style='display:none'><td><table><tr><td>in</table><tr><td>a</table>", [[["a"]]]),
    ("<table><tr><td rowspan=3>a</td><td>b</td></tr></table>", [[["a", "b"], ["a", None], ["a", None]]]),
])
def test_implied_ends_and_hanging_cells(page, expected):
    assert [body for _, body in html.read_tables(page)] == expected


def test_links_of_any_form(spark, rows):
    page = """<a href='x'>1</a><A class=k HREF="y?a=1&amp;b=2">2</A><link href="css"><a data-href="no" href=z>3</a><a name="n">4</a>"""
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "i int, html string")
    assert rows(html.extract_links(pages, "i")) == [(1, 0, "x"), (1, 1, "y?a=1&b=2"), (1, 2, "z")]
    assert rows(html.count_links(pages, "i")) == [(1, 3), (2, None), (3, 0)]


def test_lines_of_another_width_are_reported(spark, rows):
    sheet = "id_equipe,q1,q2,q3,q4,final\nBOS,1,2,3,4,10\nPHI,1,2,3,4"
    sheets = day_folders.parse_sheets(spark.createDataFrame([("a/2021-01-05/m0_2021-01-05.csv", sheet)], "path string, value string"))
    assert day_folders.game_rows(sheets).count() == 1
    assert rows(day_folders.rejected_lines(sheets), "row_idx", "line") == [(1, "PHI,1,2,3,4")]


def test_sheets_in_several_splits(spark, rows, tmp_path):
    """Large sheets are read by lines, in several tasks, and give the rows that whole sheets give."""
    from courtledger.sources.day_folders import read_split_sheets
    for name, header, n in (("m0_2020-12-22", "equipe,q1,final", 400), ("m1_2020-12-22", "equipe,q1,pr1,final", 90), ("m2_2020-12-22", "equipe,q1", 0), ("other", "x", 5)):
        (tmp_path / "2020-12-22").mkdir(exist_ok=True)
        lines = [header] + [f"T{i},{i}" + ",7" * (header.count(",") - 1 - (i % 50 == 9)) for i in range(n)]
        (tmp_path / "2020-12-22" / f"{name}.csv").write_bytes("\r\n".join(lines).encode() + b"\r\n\r\n" * (n % 3))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        split = read_split_sheets(spark, str(tmp_path))
        text = spark.read.text(str(tmp_path), pathGlobFilter="m*.csv", recursiveFileLookup=True)
        assert text.rdd.getNumPartitions() > 5
        columns = ("game_no", "row_idx", "line", "fields")
        key = lambda df: sorted(map(str, rows(df, *columns)))
        assert key(split) == key(day_folders.read_day_folders(spark, str(tmp_path))) and split.count() == 490
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
