"""Whole jobs: lists, picks, availability and the import of game days."""

import datetime

from pyspark.sql import functions as F

from courtledger.catalog.base import date, registry, table
from courtledger.functions.text import normalize_name
from courtledger.plans.available import available
from courtledger.plans.day import dedup_games as dedup_op, empty_state, next_state, process_days
from courtledger.plans.injuries import apply_injury_list, fill_placeholder_kind, normalize_injury_list
from courtledger.plans.picks import new_picks, pick_rows
from courtledger.session import cut_lineage

QUERIES, SQL, query = registry()


@query("""
    WITH listed AS (
        SELECT o_orderkey, lower(c_mktsegment) || lower(c_name) || CASE WHEN c_acctbal < 0 THEN 'jr' ELSE '' END AS nom_simple,
               n_nationkey AS id_type_blessure, make_date(CASE WHEN make_date(2000, month(o_orderdate), day(o_orderdate)) <= DATE '2000-06-15'
                   THEN 2000 ELSE 1999 END, month(o_orderdate), day(o_orderdate)) AS date_blessure
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT * FROM listed WHERE date_blessure <= DATE '2000-05-31'""")
def injury_list(spark, sf):
    """One list entry per order: short and full name, injury, day without a year."""
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    player = F.concat(F.lit("C. "), F.col("c_mktsegment"), F.lit(" "), F.col("c_mktsegment"), F.lit(" "), F.col("c_name"),
                      F.when(F.col("c_acctbal") < 0, " Jr.").otherwise(""))
    rows = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select("o_orderkey", player.alias("Player"), F.date_format("o_orderdate", "E, MMM d").alias("Updated"),
                    F.initcap("n_name").alias("Injury")))
    kinds = nation.select(F.col("n_nationkey").alias("id_type_blessure"), F.col("n_name").alias("nom_blessure_anglais"))
    return normalize_injury_list(rows, kinds, datetime.date(2000, 6, 15), "2000-05-31") \
        .select("o_orderkey", "nom_simple", "id_type_blessure", "date_blessure")


@query("""
    WITH paged AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders
                   WHERE o_orderkey <> (SELECT arg_max(o_orderkey, (year(o_orderdate), o_orderkey)) FROM orders)),
    stored AS (SELECT CAST(o_orderdate AS DATE) AS day, o_custkey FROM orders WHERE o_totalprice > 450000)
    SELECT day AS date_choix, c_custkey AS id_joueur, 7 AS saison FROM paged JOIN customer ON o_custkey = c_custkey
    WHERE NOT (day IN (SELECT day FROM stored) AND c_custkey IN (SELECT o_custkey FROM stored))""")
def picks_increment(spark, sf):
    """Orders as picks on yearly pages; large ones are stored already."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    pages = orders.select(F.year("o_orderdate").alias("page_no"), F.lit(0).alias("table_idx"), F.lit(False).alias("is_header"),
                          F.col("o_orderkey").alias("row_idx"),
                          F.array(F.date_format("o_orderdate", "yyyy-MM-dd"),
                                  F.concat(F.lit("Customer #"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))).alias("cells"))
    players = customer.select(F.col("c_custkey").alias("id_joueur"), normalize_name("c_name").alias("nom_simple"))
    known = orders.filter("o_totalprice > 450000").select(date("o_orderdate").alias("date_choix"), F.col("o_custkey").alias("id_joueur"))
    return new_picks(pick_rows(pages), players, known, 7)


@query("""
    WITH schedule AS (SELECT DISTINCT n_name AS home, c_mktsegment AS away FROM events JOIN customer ON user_id = c_custkey
        JOIN nation ON c_nationkey = n_nationkey WHERE CAST(ts AS DATE) = DATE '2024-01-20'),
    playing AS (SELECT home AS team, away AS other FROM schedule UNION SELECT away, home FROM schedule)
    SELECT c_custkey AS id_joueur, team AS id_equipe, other AS adversaire, c_name AS nom
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN playing ON n_name = team
    WHERE c_acctbal > 0
      AND NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey AND event_type = 'error' AND value > 10 AND CAST(ts AS DATE) <= DATE '2024-01-20')
      AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_totalprice > 400000)""")
def available_players(spark, sf):
    customer, nation, events, orders = (table(spark, sf, t) for t in ("customer", "nation", "events", "orders"))
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    schedule = events.join(placed, F.col("user_id") == F.col("c_custkey")).select(
        F.col("n_name").alias("equipe_domicile"), F.col("c_mktsegment").alias("equipe_exterieure"), date("ts").alias("date_match"))
    contracts = placed.select(F.col("c_custkey").alias("id_joueur"), F.col("n_name").alias("id_equipe"),
                              F.when(F.col("c_acctbal") <= 0, F.to_date(F.lit("2023-12-31"))).alias("date_fin_contrat"))
    injuries = events.filter("event_type = 'error'").select(
        F.col("user_id").alias("id_joueur"), date("ts").alias("date_blessure"),
        F.when(F.col("value") <= 10, date("ts")).alias("date_guerison"))
    picks = orders.filter("o_orderpriority = '1-URGENT' AND o_totalprice > 400000").select(F.col("o_custkey").alias("id_joueur"))
    players = customer.select(F.col("c_custkey").alias("id_joueur"), F.col("c_name").alias("nom"))
    return available(schedule, contracts, players, injuries, picks, "2024-01-20").select("id_joueur", "id_equipe", "adversaire", "nom")


@query("""
    SELECT CAST(o_orderdate AS DATE) AS game_date, o_orderpriority AS equipe_domicile, o_orderstatus AS equipe_exterieure, min(o_orderkey) AS game_no
    FROM orders o WHERE NOT EXISTS (
        SELECT 1 FROM orders s WHERE s.o_totalprice > 400000 AND s.o_orderdate = o.o_orderdate AND s.o_orderpriority = o.o_orderpriority
        AND s.o_orderstatus = o.o_orderstatus) GROUP BY ALL""")
def dedup_games(spark, sf):
    orders = table(spark, sf, "orders")
    teams = [F.col("o_orderpriority").alias("equipe_domicile"), F.col("o_orderstatus").alias("equipe_exterieure")]
    games = orders.select(date("o_orderdate").alias("game_date"), F.col("o_orderkey").alias("game_no"), *teams)
    stored = orders.filter("o_totalprice > 400000").select(date("o_orderdate").alias("date_match"), *teams)
    return dedup_op(games, stored).select("game_date", "equipe_domicile", "equipe_exterieure", "game_no")


def _day_inputs(spark, sf):
    """Events as player rows: a game per day and hour, the team by event id, users as players."""
    events = table(spark, sf, "events").withColumns({
        "game_date": date("ts"), "game_no": F.hour("ts"), "team_idx": (F.col("event_id") % 2).cast("int")})
    hours = events.select("game_date", "game_no").distinct()
    team = F.concat(F.when(F.col("team_idx") == 0, "E").otherwise("H"), F.col("game_no").cast("string"))
    games = hours.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("team_idx")).select(
        "game_date", "game_no", "team_idx", team.alias("id_equipe"),
        F.create_map(F.lit("q1"), F.col("game_no") + 1, F.lit("final"), F.col("game_no") + F.col("team_idx")).alias("periods"))
    stats = ["rebonds", "passes_dec", "steal", "contres", "tir_reussi", "tir_tentes", "pct_tir", "trois_pt_r", "trois_pt_t", "pct_3_pt",
             "lanc_frc_r", "lanc_frc_t", "pct_lfrc", "rebonds_o", "rebonds_d", "ball_perdu", "faute_p", "plus_moins", "score_ttfl"]
    players = events.select(
        "game_date", "game_no", "team_idx", F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("nom"),
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("nom_simple"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.minute("ts"), F.lit(0)).alias("minute"), F.col("value").alias("points"),
        *[F.lit(0.0).alias(c) for c in stats], F.col("event_type").isin("error", "signup").alias("dnp"),
        (F.col("event_type") == "error").alias("blesse"))
    teams = games.select("game_date", "game_no", "id_equipe", *[F.lit(1.0).alias(c) for c in (
        "pts_in_paint", "fastbreak_pts", "biggest_lead", "pts_banc", "tm_rebonds", "ball_perdu", "tm_ball_perdu", "pt_subi_ctrattaq")])
    return {"games": games, "players": players, "teams": teams}


def _import(spark, sf, groups, twice=False):
    """Groups of all days at once, or in two imports of which the second repeats the last day of the first."""
    inputs, state = _day_inputs(spark, sf), empty_state(spark)
    if twice:
        first = process_days({name: df.filter("game_date <= date'2024-01-15'") for name, df in inputs.items()}, state, groups=("match", *groups))
        stored = {g: {name: cut_lineage(df) for name, df in tables.items()} for g, tables in first.items()}
        state = next_state(state, stored)
        inputs = {name: df.filter("game_date >= date'2024-01-15'") for name, df in inputs.items()}
    return next_state(state, process_days(inputs, state, groups=groups))


_GAMES = """games AS (SELECT game_date, game_no, row_number() OVER (ORDER BY game_date, game_no) AS id_match
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS game_date, hour(ts) AS game_no FROM events))"""


@query(f"""
    WITH {_GAMES}, teams AS (SELECT *, 'E' AS t, 0 AS i FROM games UNION ALL SELECT *, 'H', 1 FROM games)
    SELECT id_match, game_date AS date_match, 'E' || game_no AS equipe_exterieure, 'H' || game_no AS equipe_domicile, 3 AS id_saison,
           t || game_no AS id_equipe, p AS id_periode, CAST(CASE WHEN p = 'q1' THEN game_no + 1 ELSE game_no + i END AS INTEGER) AS score_periode
    FROM teams, (VALUES ('q1'), ('final')) AS periods(p)""")
def day_import_games(spark, sf):
    state = _import(spark, sf, ["match"])
    return state["match"].join(state["score_match"], "id_match").select(
        "id_match", "date_match", "equipe_exterieure", "equipe_domicile", "id_saison", "id_equipe", "id_periode", "score_periode")


@query("""
    WITH states AS (SELECT user_id, CAST(ts AS DATE) AS day,
            arg_max((CASE WHEN event_id % 2 = 0 THEN 'E' ELSE 'H' END) || hour(ts), (hour(ts), event_id % 2)) AS team
        FROM events WHERE event_type <> 'signup' GROUP BY ALL),
    marked AS (SELECT *, lag(team) OVER (PARTITION BY user_id ORDER BY day) AS before FROM states)
    SELECT 'user' || user_id AS nom_simple, team AS id_equipe, day AS date_debut_contrat,
           lead(day) OVER (PARTITION BY user_id ORDER BY day) - 1 AS date_fin_contrat FROM marked WHERE before IS NULL OR before <> team""")
def day_import_contracts(spark, sf):
    state = _import(spark, sf, ["joueur", "contrat"], twice=True)
    return state["contrat"].join(state["joueur"].select("id_joueur", "nom_simple"), "id_joueur").select(
        "nom_simple", "id_equipe", "date_debut_contrat", "date_fin_contrat")


@query("""
    WITH states AS (SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS hurt
        FROM events WHERE event_type <> 'signup' GROUP BY ALL),
    marked AS (SELECT *, lag(hurt) OVER (PARTITION BY user_id ORDER BY day) AS before FROM states),
    runs AS (SELECT *, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next_day FROM marked WHERE before IS NULL OR before <> hurt)
    SELECT 'user' || user_id AS nom_simple, 99 AS id_type_blessure, day AS date_blessure, next_day - 1 AS date_guerison FROM runs WHERE hurt""")
def day_import_injuries(spark, sf):
    state = _import(spark, sf, ["joueur", "blesse"], twice=True)
    return state["blessure"].join(state["joueur"].select("id_joueur", "nom_simple"), "id_joueur").select(
        "nom_simple", "id_type_blessure", "date_blessure", "date_guerison")


@query(f"""
    WITH {_GAMES}
    SELECT id_match, id_joueur, value AS points, printf('00:%02d:00', minute(ts)) AS minute
    FROM events JOIN games ON CAST(ts AS DATE) = game_date AND hour(ts) = game_no
    JOIN (SELECT user_id, row_number() OVER (ORDER BY 'user' || user_id) AS id_joueur FROM (SELECT DISTINCT user_id FROM events)) USING (user_id)
    WHERE event_type NOT IN ('error', 'signup')""")
def day_import_facts(spark, sf):
    return _import(spark, sf, ["stats"])["stats_joueur"].select("id_match", "id_joueur", "points", "minute")


@query("""
    WITH latest AS (SELECT DISTINCT ON (o_custkey) o_custkey, CAST(left(o_orderpriority, 1) AS INTEGER) AS kind FROM orders
                    ORDER BY o_custkey, CAST(o_orderdate AS DATE) DESC, kind DESC)
    SELECT c_custkey AS id_joueur, CASE WHEN c_acctbal > 0 AND c_custkey % 3 <> 0 AND kind IS NOT NULL THEN kind WHEN c_custkey % 3 <> 0 THEN 99 ELSE 5 END AS id_type_blessure,
           CASE WHEN c_acctbal <= 0 THEN DATE '2024-02-01' END AS date_guerison FROM customer LEFT JOIN latest ON o_custkey = c_custkey""")
def fill_placeholder(spark, sf):
    """Open spells of the placeholder kind take the kind that was listed last for the name."""
    customer, orders = table(spark, sf, "customer"), table(spark, sf, "orders")
    members = customer.select(F.col("c_custkey").alias("id_joueur"), F.col("c_name").alias("nom_simple"))
    spells = customer.select(F.col("c_custkey").alias("id_joueur"), F.when(F.col("c_custkey") % 3 != 0, 99).otherwise(5).alias("id_type_blessure"),
                             F.to_date(F.lit("2024-01-01")).alias("date_blessure"), F.when(F.col("c_acctbal") <= 0, F.to_date(F.lit("2024-02-01"))).alias("date_guerison"))
    named = members.withColumnRenamed("id_joueur", "o_custkey")
    listed = orders.join(named, "o_custkey").select("nom_simple", F.substring("o_orderpriority", 1, 1).cast("int").alias("id_type_blessure"), date("o_orderdate").alias("date_blessure"))
    return fill_placeholder_kind(spells, members, listed).select("id_joueur", "id_type_blessure", "date_guerison")


@query("""
    WITH listed AS (SELECT c_custkey AS id, n_nationkey AS kind, c_custkey % 4 AS g FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0),
    last AS (SELECT o_custkey AS id, max(CAST(o_orderdate AS DATE)) AS day FROM orders GROUP BY 1)
    SELECT c_custkey AS id_joueur, CASE WHEN c_custkey % 4 = 0 THEN coalesce(kind, 99) ELSE 7 END AS id_type_blessure, DATE '2023-06-01' AS date_blessure,
           CASE WHEN c_custkey % 4 = 2 THEN DATE '2023-07-01' END AS date_guerison
    FROM customer LEFT JOIN listed ON id = c_custkey WHERE c_custkey % 4 < 3
    UNION ALL SELECT id, kind, day + 1, NULL FROM listed JOIN last USING (id) WHERE g > 1
    UNION ALL SELECT id, kind, DATE '2024-01-10', NULL FROM listed WHERE g > 1 AND id NOT IN (SELECT id FROM last)""")
def injury_chain(spark, sf):
    """An injury list in its three steps: kinds of open spells, spells after the last fact, spells of those never seen."""
    customer, orders, nation = (table(spark, sf, t) for t in ("customer", "orders", "nation"))
    day, group = lambda text: F.to_date(F.lit(text)), F.col("c_custkey") % 4
    members = customer.select(F.col("c_custkey").alias("id_joueur"), F.col("c_name").alias("nom_simple"))
    spells = customer.filter(group < 3).select(
        F.col("c_custkey").alias("id_joueur"), F.when(group == 0, 99).otherwise(7).alias("id_type_blessure"), day("2023-06-01").alias("date_blessure"),
        F.when(group == 2, day("2023-07-01")).alias("date_guerison"))
    listed = customer.filter("c_acctbal > 0").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("nom_simple"), F.lower("n_name").alias("Injury"), F.col("n_nationkey").alias("id_type_blessure"), day("2024-01-10").alias("date_blessure"))
    last = orders.groupBy("o_custkey").agg(F.max(date("o_orderdate")).alias("date_match"))
    facts = last.join(members, F.col("o_custkey") == F.col("id_joueur")).select("nom_simple", "id_joueur", "date_match")
    kinds = nation.select(F.col("n_nationkey").alias("id_type_blessure"), F.col("n_name").alias("nom_blessure_anglais"))
    return apply_injury_list(spells, members, listed, facts, kinds, store=cut_lineage).select("id_joueur", "id_type_blessure", "date_blessure", "date_guerison")
