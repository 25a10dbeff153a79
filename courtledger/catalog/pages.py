"""Links, tables and sheets, from the pages table and from pages Spark writes out of other tables."""

import datetime

from pyspark.sql import functions as F

from courtledger.catalog.base import date, registry, spread, table
from courtledger.functions.text import normalize_name, url_basename, url_parent, url_path
from courtledger.operators.reshape import melt_map
from courtledger.plans.box_score import game_tables as game_tables_op, normalize_box_score, team_facts, team_tables
from courtledger.plans.injuries import accepted, rejected, tag_injuries
from courtledger.plans.picks import new_picks, pick_rows
from courtledger.plans.profiles import player_dimension
from courtledger.plans.schedule import build_schedule
from courtledger.session import cut_lineage
from courtledger.sources.day_folders import game_rows, parse_sheets, player_rows, rejected_lines, rejected_sheets
from courtledger.sources.html import (count_links, element_texts, extract_html_tables, extract_links,
                                      pages_without_tables as without_op, rows_by_header)

QUERIES, SQL, query = registry()


@query("""
    WITH found AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages)
    SELECT page_id, CAST(i - 1 AS INTEGER) AS link_idx, links[i] AS link FROM (SELECT *, unnest(range(1, len(links) + 1)) AS i FROM found)""")
def link_harvest(spark, sf):
    return extract_links(table(spark, sf, "pages"), "page_id")


@query("""
    SELECT page_id, CAST(len(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS INTEGER) AS n_links FROM pages""")
def link_count(spark, sf):
    return count_links(table(spark, sf, "pages"), "page_id")


@query(r"""
    WITH paths AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    parts AS (SELECT *, string_split(path, '/') AS p, string_split(rtrim(path, '/'), '/') AS q FROM paths)
    SELECT page_id, path, p[-1] AS base, CASE WHEN len(q) > 1 AND q[-2] <> '' THEN q[-2] END AS parent FROM parts""")
def url_parts(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_path("url").alias("path"), url_basename("url").alias("base"),
                                            url_parent("url").alias("parent"))


@query("""
    WITH linked AS (SELECT CAST(o_orderdate AS DATE) AS day, lower(c_mktsegment) AS a, lower(n_name) AS b, o_orderstatus AS s
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT DISTINCT upper(right(a, 3)) AS equipe_exterieure, upper(left(b, 3)) AS equipe_domicile, day AS date_match, 3 AS id_saison
    FROM linked WHERE s <> 'P'""")
def schedule_build(spark, sf):
    """One link per order, two spellings: only those with the separator name a game."""
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    separator = F.when(F.col("o_orderstatus") == "P", "-at-").otherwise("-vs-")
    links = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .select(date("o_orderdate").alias("day"),
                     F.concat(F.lit("https://scores.example.com/game/"), F.lower("c_mktsegment"), separator, F.lower("n_name"),
                              F.lit("-"), F.col("o_orderkey").cast("string")).alias("link")))
    return build_schedule(links, "day", "link", 3)


_ROW = "<tr><td>%s</td><td>%s</td><td></td></tr>"


@query("""
    SELECT page_id, 0 AS table_idx, true AS is_header, 0 AS row_idx, 1 AS n_rows, 'url|path|~' AS cells FROM pages
    UNION ALL SELECT page_id, 0, false, 0, 2, url || '|' || page_id || '|~' FROM pages
    UNION ALL SELECT page_id, 0, false, 1, 2, length(html) || '|total|~' FROM pages""")
def page_tables(spark, sf):
    """Every page, read whole, with a table of its own particulars put before its end."""
    pages = table(spark, sf, "pages")
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    extra = F.concat(F.lit("<table><thead><tr><th>url</th><th>path</th><th></th></tr></thead><tbody>"),
                     F.format_string(_ROW, escaped, F.col("page_id").cast("string")),
                     F.lit("</tbody><tfoot>"), F.format_string(_ROW, F.length("html").cast("string"), F.lit("total")),
                     F.lit("</tfoot></table></body></html>"))
    pages = pages.withColumn("html", F.concat(F.replace(F.col("html"), F.lit("</body></html>"), F.lit("")), extra))
    tables = extract_html_tables(pages, "page_id")
    return tables.withColumn("cells", F.array_join("cells", "|", "~"))


@query("SELECT page_id, url FROM pages WHERE html IS NULL OR NOT contains(lower(html), '<table')")
def pages_without_tables(spark, sf):
    return without_op(table(spark, sf, "pages")).select("page_id", "url")


@query("""
    SELECT p_partkey, t AS table_idx, r AS row_idx, CASE WHEN t = 0 THEN CASE r WHEN 0 THEN p_name || '|' || p_size || '|wide|wide'
            ELSE p_name || '|' || p_brand || '|~|~' END
        ELSE p_type || '|' || (CASE r WHEN 0 THEN 'a & b' ELSE 'x  y' END) END AS cells
    FROM part, range(2) AS x(t64), range(2) AS y(r64), LATERAL (SELECT CAST(t64 AS INTEGER) AS t, CAST(r64 AS INTEGER) AS r)""")
def html_tables(spark, sf):
    """Two tables per part: spans, short rows, entities, white space, unclosed cells, hidden text."""
    tags = ("<p>before</p><table><tr><th>n</th><th>s</th></tr><tr><td rowspan=2>%s</td><td>%d</td><td colspan='2'>wide</td></tr>"
            "<tr><td>%s<span style='display: none'>no</span></td></tr></table><table></table>"
            "<table><tr><td rowspan='2'> %s <td>a &amp; b<tr><td>x\n\n  y<script>var t='</td>';</script></table>")
    pages = spread(table(spark, sf, "part"), "p_partkey").select("p_partkey", F.format_string(tags, "p_name", "p_size", "p_brand", "p_type").alias("html"))
    tables = extract_html_tables(pages, "p_partkey").filter("NOT is_header")
    return tables.select("p_partkey", "table_idx", "row_idx", F.array_join("cells", "|", "~").alias("cells"))


@query("""
    SELECT p_partkey, t AS table_idx, r AS row_idx, CASE WHEN t = 1 THEN p_brand WHEN r = 0 THEN p_name || '|' || p_size ELSE p_type || '|~' END AS cells
    FROM part, (VALUES (0, 0), (0, 1), (1, 0)) AS places(t, r)""")
def hidden_cells(spark, sf):
    """Hidden rows, cells and list items without end tags, and a cell that hangs over the end: what is shown comes out whole."""
    tags = ("<ul><li style='display:none'>no</ul><p style='display: none'>no<table><tr style='display:none'><td>no<tr><td>%s<td style='display:none'>no"
            "<td>%d<tr><td>%s<div style='display:none'>no<td></table><table><tr><td>%s</table>")
    pages = table(spark, sf, "part").select("p_partkey", F.format_string(tags, "p_name", "p_size", "p_type", "p_brand").alias("html"))
    return extract_html_tables(pages, "p_partkey").select("p_partkey", "table_idx", "row_idx", F.array_join("cells", "|", "~").alias("cells"))


@query("""
    SELECT c_custkey, CAST(t AS INTEGER) AS table_idx, CASE WHEN t = 0 THEN c_name ELSE c_mktsegment END AS "Player",
           CASE WHEN t = 0 THEN 'Sat, Mar 4' END AS "Updated", CASE WHEN t = 0 THEN c_mktsegment ELSE c_name END AS "Injury" FROM customer, range(2) AS x(t)""")
def injury_pages(spark, sf):
    """All tables of a page under their header's names, whatever their order; a name that a table lacks is null."""
    tags = ("<table><thead><tr><th>Player<th>Updated<th>Injury</thead><tr><td>%s<td>Sat, Mar 4<td>%s</table>"
            "<table><tr><th>Injury</th><th>Player</th></tr><tr><td>%s</td><td>%s</td></tr></table>")
    pages = table(spark, sf, "customer").select("c_custkey", F.format_string(tags, "c_name", "c_mktsegment", "c_name", "c_mktsegment").alias("html"))
    return rows_by_header(extract_html_tables(pages, "c_custkey"), "c_custkey", ["Player", "Updated", "Injury"]).drop("row_idx")


@query(r"""
    SELECT page_id, replace(regexp_replace(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '\s+', ' ', 'g'), '&amp;', '&')
           || '|' || page_id || '|' || page_id || 'abc|b|bare' || CASE WHEN page_id % 2 = 0 THEN '|open to the end' ELSE '' END AS value_texts FROM pages""")
def profile_pages(spark, sf):
    """Ordered texts of the elements of a tag and class, tags inside dropped; read from whole pages. Some elements lie within others, or
    within elements of their tag, one has no quotes, some have no end."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    extra = F.concat(F.lit('<div class="row value big"><b>'), title, F.lit("</b></div><div class='values'>no</div><DIV data-x=1 class='value'>\n"),
                     F.col("page_id").cast("string"), F.lit("  </DIV></div></div><div title='a>b' class=\"value\">"), F.col("page_id").cast("string"),
                     F.lit("a<div class=other><div></div></div><div class='value x'>b</div>c</div><div id=x class=value>bare</div>"),
                     F.when(F.col("page_id") % 2 == 0, "<div class=value>open <div>to</div> the end").otherwise(""))
    pages = table(spark, sf, "pages").select("page_id", F.concat("html", extra).alias("html"))
    return pages.select("page_id", F.array_join(element_texts("html", "div", "value"), "|").alias("value_texts"))


# A box-score page per part: two tables of seven players and a totals row; all numbers follow from the
# part's key k and size s, the table t and the row r.
_NUMBERS = {
    "tir_reussi": "(k + r + t) % 10", "tir_tentes": "(k + r + t) % 10 + r % 4", "pct_tir": "s",
    "trois_pt_r": "r % 3", "trois_pt_t": "r % 3 + t", "pct_3_pt": "r",
    "lanc_frc_r": "s % 5", "lanc_frc_t": "s % 5 + r % 2", "pct_lfrc": "t",
    "rebonds_o": "r % 2", "rebonds_d": "s % 6", "rebonds": "r % 2 + s % 6",
    "passes_dec": "k % 7", "steal": "r % 3", "contres": "t", "ball_perdu": "s % 4", "faute_p": "r % 5",
    "points": "2 * ((k + r + t) % 10) + r % 3 + s % 5", "plus_moins": "r - 3",
}
_SCORE = ("2 * ((k + r + t) % 10) + r % 3 + s % 5 + r % 2 + s % 6 + k % 7 + r % 3 + t + (k + r + t) % 10 + r % 3 + s % 5"
          " - (s % 4 + r % 4 + t + r % 2)")
_OUT = r"(r = 5 OR (r = 6 AND t = 1))"


@query(f"""
    WITH rows AS (SELECT p_partkey, p_partkey AS k, p_size AS s, CAST(t64 AS INTEGER) AS t, CAST(r64 AS INTEGER) AS r, p_name
                  FROM part, range(2) AS x(t64), range(7) AS y(r64))
    SELECT p_partkey, t AS team_idx, r AS row_idx, string_split(p_name, ' ')[1] || ' O''' || string_split(p_name, ' ')[2] AS nom,
           lower(replace(p_name, ' ', 'o')) AS nom_simple, {_OUT} AS dnp, r = 6 AND t = 1 AS blesse,
           CASE WHEN {_OUT} THEN '' ELSE printf('00:%02d:%02d', CAST(s AS INTEGER), CAST(r * 7 AS INTEGER)) END AS minute,
           CASE WHEN NOT {_OUT} THEN CAST({_NUMBERS['points']} AS DOUBLE) END AS points,
           CASE WHEN NOT {_OUT} THEN CAST(r - 3 AS DOUBLE) END AS plus_moins,
           CASE WHEN NOT {_OUT} THEN CAST({_SCORE} AS DOUBLE) END AS score_ttfl, 0 AS n_rejected FROM rows""")
def box_score(spark, sf):
    """Pages to clean player rows, the whole way."""
    from courtledger.functions.temporal import format_duration
    players = normalize_box_score(extract_html_tables(_box_pages(spark, sf), "p_partkey"), keys=["p_partkey"])
    return players.select("p_partkey", "team_idx", "row_idx", "nom", "nom_simple", "dnp", "blesse", format_duration("minute").alias("minute"),
                          "points", "plus_moins", "score_ttfl", F.size("rejected").alias("n_rejected"))


def _box_pages(spark, sf):
    minute = ("CASE WHEN r = 5 THEN 'DNP - Coach''s Decision' WHEN r = 6 AND t = 1 THEN 'DNP - Injury/Illness' "
              "WHEN r = 4 THEN concat(s, '.000000:', lpad(r * 7, 2, '0')) ELSE concat(s, ':', lpad(r * 7, 2, '0')) END").replace("''", "\\'")
    name = "concat(split(p_name, ' ')[0], ' O&#39;', split(p_name, ' ')[1], 'JO', if(r < 5, 'F', ''))"
    cells = ", '</td><td>', ".join(["concat('', " + name + ")", minute, *_NUMBERS.values()])
    rows = f"array_join(transform(sequence(0, 6), r -> concat('<tr><td>', {cells}, '</td></tr>')), '')"
    tables = (f"array_join(transform(sequence(0, 1), t -> concat('<table><thead><tr><th>player</th></tr></thead><tbody>', {rows}, "
              "'<tr><td>TOTALS</td><td>240:00</td></tr></tbody></table>')), '<hr>')")
    return spread(table(spark, sf, "part"), "p_partkey").selectExpr("p_partkey", "p_name", "p_partkey AS k", "p_size AS s") \
        .select("p_partkey", F.concat(F.lit("<html><body>"), F.expr(tables), F.lit("</body></html>")).alias("html"))


_SUMMARY = """
    WITH teams AS (SELECT p_partkey, p_size AS s, CAST(t64 AS INTEGER) AS t FROM part, range(2) AS x(t64))"""


def _summary_tables(spark, sf):
    """A summary page per part: the game table, with as many overtimes as p_size % 3, and the team statistics."""
    row = ("concat('<tr><td>T', t, '</td><td>', array_join(concat(array(s, s + 1, t, 3), "
           "if(s % 3 > 0, transform(sequence(1, s % 3), i -> i * 10 + t), array()), array(2 * s + 4 + t + 10 * (s % 3))), '</td><td>'), '</td></tr>')")
    stats = "concat('<tr><td>T', t, '</td><td>', array_join(transform(sequence(1, 8), i -> i * s + t), '</td><td>'), '</td></tr>')"
    html = (f"concat('<table><tr><th>team</th></tr>', array_join(transform(sequence(0, 1), t -> {row}), ''), '</table>"
            f"<table>', array_join(transform(sequence(0, 1), t -> {stats}), ''), '</table>')")
    pages = spread(table(spark, sf, "part"), "p_partkey").selectExpr("p_partkey", "p_size AS s").selectExpr("p_partkey", f"{html} AS html")
    return extract_html_tables(pages, "p_partkey")


@query(_SUMMARY + """
    SELECT p_partkey, t AS team_idx, 'T' || t AS id_equipe, p AS id_periode, CAST(v AS INTEGER) AS score_periode FROM (
        SELECT *, 'q1' AS p, s AS v FROM teams UNION ALL SELECT *, 'q2', s + 1 FROM teams UNION ALL SELECT *, 'q3', t FROM teams
        UNION ALL SELECT *, 'q4', 3 FROM teams UNION ALL SELECT *, 'pr1', 10 + t FROM teams WHERE s % 3 > 0
        UNION ALL SELECT *, 'pr2', 20 + t FROM teams WHERE s % 3 > 1
        UNION ALL SELECT *, 'final', 2 * s + 4 + t + 10 * (s % 3) FROM teams)""")
def game_tables(spark, sf):
    games = game_tables_op(_summary_tables(spark, sf), keys=["p_partkey"])
    return melt_map(games, ["p_partkey", "team_idx", "id_equipe"], "periods", "id_periode", "score_periode")


@query(_SUMMARY + """
    SELECT p_partkey AS id_match, 'T' || t AS id_equipe, CAST(s + t AS DOUBLE) AS pts_in_paint, CAST(2 * s + t AS DOUBLE) AS fastbreak_pts,
           CAST(3 * s + t AS DOUBLE) AS biggest_lead, CAST(4 * s + t AS DOUBLE) AS pts_banc, CAST(5 * s + t AS DOUBLE) AS tm_rebonds,
           CAST(6 * s + t AS DOUBLE) AS ball_perdu, CAST(7 * s + t AS DOUBLE) AS tm_ball_perdu, CAST(8 * s + t AS DOUBLE) AS pt_subi_ctrattaq
    FROM teams""")
def team_stats(spark, sf):
    teams = team_tables(_summary_tables(spark, sf), keys=["p_partkey"])
    return team_facts(teams.withColumnRenamed("p_partkey", "id_match"))


@query("""
    WITH games AS (SELECT p_partkey, p_size AS s, CAST(t64 AS INTEGER) AS t, CASE WHEN p_size % 3 = 0 THEN 4 ELSE 5 END AS n FROM part, range(2) AS x(t64))
    SELECT DATE '2020-12-22' + s AS game_date, CAST(p_partkey AS INTEGER) AS game_no, t AS team_idx, 'T' || t AS id_equipe,
           CAST(s + t AS INTEGER) AS q1, CASE WHEN n = 5 THEN CAST(s * 2 AS INTEGER) END AS pr1, CAST(s + 100 AS INTEGER) AS final FROM games""")
def game_sheets(spark, sf):
    """A game sheet per part, with and without an overtime column."""
    path = "concat('/d/', date_add(date'2020-12-22', s), '/m', k, '_', date_add(date'2020-12-22', s), '.csv')"
    line = "concat('T', t, ',', s + t, ',1,2,3,', if(s % 3 = 0, '', concat(s * 2, ',')), s + 100)"
    value = (f"concat('equipe,q1,q2,q3,q4,', if(s % 3 = 0, '', 'pr1,'), 'final\\r\\n', "
             f"array_join(transform(sequence(0, 1), t -> {line}), '\\r\\n'), '\\r\\n')")
    sheets = table(spark, sf, "part").selectExpr("p_partkey AS k", "p_size AS s").selectExpr(f"{path} AS path", f"{value} AS value")
    period = lambda p: F.try_element_at("periods", F.lit(p)).alias(p)
    return game_rows(parse_sheets(sheets)).select("game_date", "game_no", "team_idx", "id_equipe", period("q1"), period("pr1"), period("final"))


@query("""
    SELECT DATE '2020-12-22' + p_size AS game_date, CAST(p_partkey AS INTEGER) AS game_no, 1 AS team_idx, CAST(r64 AS INTEGER) AS row_idx,
           p_name || r64 AS nom, CASE WHEN r64 = 0 THEN CAST(p_size AS INTEGER) * 60 + 5 END AS seconds,
           CASE WHEN r64 = 0 THEN CAST(p_size AS DOUBLE) END AS points, r64 = 1 AS dnp FROM part, range(2) AS x(r64)""")
def player_sheets(spark, sf):
    from courtledger.functions.temporal import interval_seconds
    path = "concat('/d/', date_add(date'2020-12-22', s), '/m', k, '_equipe1_', date_add(date'2020-12-22', s), '.csv')"
    line = "if(r = 0, concat(p_name, r, ',0 days 00:', lpad(s, 2, '0'), ':05,', s, '.0,False'), concat(p_name, r, ',,,True'))"
    value = f"concat('nom,minute,points,dnp\\n', array_join(transform(sequence(0, 1), r -> {line}), '\\n'))"
    sheets = table(spark, sf, "part").selectExpr("p_partkey AS k", "p_size AS s", "p_name").selectExpr(f"{path} AS path", f"{value} AS value")
    return player_rows(parse_sheets(sheets)).select("game_date", "game_no", "team_idx", "row_idx", "nom",
                                                    interval_seconds("minute").cast("int").alias("seconds"), "points", "dnp")


@query(r"""
    SELECT 1.5 + (c_custkey % 50) / 100.0 AS taille_text, c_custkey, CAST(printf('1.%02d', CAST(50 + c_custkey % 50 AS INTEGER)) AS DOUBLE) AS taille,
           CAST(60 + c_custkey % 60 AS DOUBLE) AS poids, c_mktsegment AS pays,
           DATE '1990-01-01' + CAST(c_custkey % 5000 AS INTEGER) AS date_naissance, 'draft ' || c_nationkey AS draft, 'Rookie' AS experience,
           'First ' || c_name AS nom, 'firstcustomer#' || substr(c_name, 10) AS nom_simple, 'C-NC' AS id_position_terrain
    FROM customer WHERE c_mktsegment <> 'MACHINERY'""".replace("1.5 + (c_custkey % 50) / 100.0 AS taille_text, ", ""))
def player_profiles(spark, sf):
    """Profile values of customers, eleven or twelve of them; some pages have none."""
    k = F.col("c_custkey")
    born = F.date_format(F.date_add(F.to_date(F.lit("1990-01-01")), (k % 5000).cast("int")), "MMMM d, yyyy")
    head = [F.format_string("x (1.%02dm)", k % 50 + 50), F.format_string("y (%dkg)", k % 60 + 60), F.col("c_mktsegment")]
    tail = [born, F.concat(F.lit("draft "), F.col("c_nationkey").cast("string")), F.lit("Rookie")]
    rest = [F.lit("-")] * 4
    values = (F.when(F.col("c_mktsegment") == "MACHINERY", F.array().cast("array<string>"))
               .when(F.col("c_acctbal") < 0, F.array(*head, F.lit("college"), *tail, *rest))
               .otherwise(F.array(*head, F.lit("college"), F.lit("age"), *tail, *rest)))
    profiles = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("link"), values.alias("values"),
        F.array(F.lit("Club | #7 | Center-Staff"), F.lit("First"), F.col("c_name"), F.lit("more")).alias("header"))
    return player_dimension(profiles).withColumn("c_custkey", F.col("page_web").cast("long")).drop("page_web")


@query("""
    WITH listed AS (SELECT o_orderkey AS k, o_orderstatus AS s, n_name, CAST(o_orderdate AS DATE) AS d FROM orders JOIN customer ON o_custkey = c_custkey
                    JOIN nation ON c_nationkey = n_nationkey WHERE o_orderkey % 11 <> 0)
    SELECT CASE WHEN k % 7 = 0 THEN 'name' WHEN k % 5 = 0 THEN 'date'
                WHEN strftime(d, '%m-%d') > '05-31' AND strftime(d, '%m-%d') <= '06-15' THEN 'later'
                WHEN s = 'P' THEN 'injury' ELSE 'read' END AS reason, count(*) AS n FROM listed GROUP BY 1
    UNION ALL SELECT 'page', count(*) FROM orders WHERE o_orderkey % 11 = 0 HAVING count(*) > 0""")
def page_rejects(spark, sf):
    """A page per order, some without a table, some rows with a fault: all that is read and all that is left out, with the reason."""
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    key = F.col("o_orderkey")
    faulty = lambda step, text, otherwise: F.when(key % step == 0, text).otherwise(otherwise)
    cells = [faulty(7, "", "C. Name Some Name"), faulty(5, "unknown", F.date_format("o_orderdate", "E, MMM d")),
             F.when(F.col("o_orderstatus") == "P", "Homesickness").otherwise(F.initcap("n_name"))]
    page = F.concat(F.lit("<table><tr><th>Player<th>Updated<th>Injury<tr>"), *[F.concat(F.lit("<td>"), c) for c in cells], F.lit("</table>"))
    pages = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .select("o_orderkey", faulty(11, "<p>not today</p>", page).alias("html")))
    rows = rows_by_header(extract_html_tables(pages, "o_orderkey"), "o_orderkey", ["Player", "Updated", "Injury"])
    kinds = nation.select(F.col("n_nationkey").alias("id_type_blessure"), F.col("n_name").alias("nom_blessure_anglais"))
    tagged = cut_lineage(tag_injuries(rows.withColumn("Player", F.nullif("Player", F.lit(""))), kinds, datetime.date(2000, 6, 15), "2000-05-31"))
    found = (accepted(tagged).select(F.lit("read").alias("reason")).unionByName(rejected(tagged).select("reason"))
             .unionByName(without_op(pages).select(F.lit("page").alias("reason"))))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""
    SELECT reason, CAST(n AS BIGINT) AS n FROM (
        SELECT 'read' AS reason, sum(CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 2 END) AS n FROM part WHERE p_partkey % 7 <> 0
        UNION ALL SELECT 'width', count(*) FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 5 = 0
        UNION ALL SELECT 'path', count(*) FROM part WHERE p_partkey % 7 = 0)""")
def sheet_rejects(spark, sf):
    """Game sheets, some with a line of another width, some with a path that names no day: lines read, and what was left out."""
    day = "if(k % 7 = 0, '2020-13-41', '2020-12-22')"
    value = "concat('equipe,q1,final\\r\\nA,1,2\\r\\nB,3', if(k % 5 = 0, '', ',4'), '\\r\\n')"
    sheets = table(spark, sf, "part").selectExpr("p_partkey AS k").selectExpr(f"concat('/d/', {day}, '/m', k, '_', {day}, '.csv') AS path", f"{value} AS value")
    lines = parse_sheets(sheets)
    reasons = [game_rows(lines).select(F.lit("read").alias("reason")), rejected_lines(lines).select(F.lit("width").alias("reason")),
               rejected_sheets(sheets).select(F.lit("path").alias("reason"))]
    found = reasons[0].unionByName(reasons[1]).unionByName(reasons[2])
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH paged AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders
                   WHERE o_orderkey <> (SELECT arg_max(o_orderkey, (CAST(o_orderdate AS DATE), o_orderkey)) FROM orders)),
    stored AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey FROM orders WHERE o_totalprice > 450000)
    SELECT day AS date_choix, c_custkey AS id_joueur, 7 AS saison FROM paged JOIN customer ON o_custkey = c_custkey
    WHERE NOT (day IN (SELECT day FROM stored) AND c_custkey IN (SELECT o_custkey FROM stored))""")
def picks_pages(spark, sf):
    """From pages to new picks: the orders of a day, at most a thousand to a page, as a paged history that ends with a row that is none."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    row = F.format_string("<tr><td>%s</td><td>Customer #%09d</td></tr>", F.date_format("o_orderdate", "yyyy-MM-dd"), "o_custkey")
    page_no = F.datediff(date("o_orderdate"), F.to_date(F.lit("1990-01-01"))).cast("long") * 1_000_000_000 + F.floor(F.col("o_orderkey") / 1000)
    pages = (orders.groupBy(page_no.alias("page_no")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("row")))).alias("rows"))
             .select("page_no", F.concat(F.lit("<html><table><thead><tr><th>Date<th>Joueur</thead>"), F.array_join("rows.row", ""),
                                         F.lit("</table><table><tr><td>other</table>")).alias("html")))
    players = customer.select(F.col("c_custkey").alias("id_joueur"), normalize_name("c_name").alias("nom_simple"))
    known = orders.filter("o_totalprice > 450000").select(date("o_orderdate").alias("date_choix"), F.col("o_custkey").alias("id_joueur"))
    return new_picks(pick_rows(extract_html_tables(pages, "page_no")), players, known, 7)


@query("""
    WITH linked AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS s, lower(c_mktsegment) AS a, lower(n_name) AS b
                    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT DISTINCT upper(right(a, 3)) AS equipe_exterieure, upper(left(b, 3)) AS equipe_domicile, day AS date_match, 3 AS id_saison
    FROM linked WHERE s <> 'P'""")
def schedule_pages(spark, sf):
    """From pages to the schedule: a page per order, with a link to a game among others."""
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    separator = F.when(F.col("o_orderstatus") == "P", "-at-").otherwise("-vs-")
    game = F.concat(F.lit("/game/"), F.lower("c_mktsegment"), separator, F.lower("n_name"), F.lit("-"), F.col("o_orderkey").cast("string"))
    pages = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .select("o_orderkey", date("o_orderdate").alias("day"),
                     F.concat(F.lit("<a href='/home'>home</a><ul><li><a class=x href="), game, F.lit(">game</a><a href=\""), game, F.lit("\">again</a></ul>")).alias("html")))
    return build_schedule(extract_links(pages, ["o_orderkey", "day"], containing="/game/"), "day", "link", 3)
