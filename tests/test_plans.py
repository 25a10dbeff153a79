import datetime

import pytest
from pyspark.sql import functions as F

from courtledger import schemas
from courtledger.plans import day, injuries, picks, profiles, schedule
from courtledger.plans.available import available

D = datetime.date


def box_table(*players):
    """The first five names, those of the starters, carry one more character."""
    players = [[p[0] + ("F" if i < 5 else ""), *p[1:]] for i, p in enumerate(players)]
    rows = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in p) + "</tr>" for p in players)
    return f"<table><thead><tr><th>player</th></tr></thead><tbody>{rows}<tr><td>TOTALS</td><td>240:00</td></tr></tbody></table>"


def player(name, minute, points="10", made="4", attempted="9"):
    """A raw row: initials follow the name."""
    initials = "".join(w[0] for w in name.split())[:2]
    numbers = [made, attempted, "44.4", "1", "3", "33.3", "1", "2", "50.0", "1", "4", "5", "6", "1", "0", "2", "3", points, "-4"]
    return [name + initials, minute, *numbers]


def out(name, text):
    return [name + "".join(w[0] for w in name.split())[:2], text, *[""] * 19]


def summary(away, home, away_points, home_points):
    game = lambda team, points: "<tr>" + "".join(f"<td>{v}</td>" for v in (team, *points)) + "</tr>"
    stats = lambda team: f"<tr><td>{team}</td>" + "".join(f"<td>{i}</td>" for i in range(8)) + "</tr>"
    return (f"<table><tr><th>team</th></tr>{game(away, away_points)}{game(home, home_points)}</table>"
            f"<table>{stats(away)}{stats(home)}</table>")


def day_pages(spark, date, games):
    records = []
    for no, (away, home, away_players, home_players) in enumerate(games):
        records.append((D.fromisoformat(date), no, "box", box_table(*away_players) + box_table(*home_players)))
        records.append((D.fromisoformat(date), no, "summary", summary(away, home, (1, 2, 3, 4, 10), (2, 2, 3, 4, 11))))
    return spark.createDataFrame(records, "game_date date, game_no int, kind string, html string")


def test_box_score_page(spark):
    team = [player(f"Al Player{i}", "36:13") for i in range(4)] + [player("P.J. O'Neal-Smith", "36.000000:07")]
    bench = [player("Bo Bench", "0:00"), out("Cy Hurt", "DNP - Injury/Illness"), player("Di Late", "what"),
             player("Ed Typo", "12:00", points="ten")]
    read = day.read_day_pages(day_pages(spark, "2021-01-05", [("BOS", "PHI", team + bench, team)]))
    rows = {(r["team_idx"], r["nom"]): r for r in read["players"].collect()}
    assert len(rows) == 14
    star = rows[0, "P.J. O'Neal-Smith"]
    assert star["nom_simple"] == "pjonealsmith" and str(star["minute"]) == "0:36:07" and star["points"] == 10.0
    assert star["score_ttfl"] == (10 + 5 + 6 + 1 + 0 + 4 + 1 + 1) - (2 + 5 + 2 + 1)
    assert rows[0, "Bo Bench"]["dnp"] and rows[0, "Bo Bench"]["points"] is None and rows[0, "Bo Bench"]["score_ttfl"] is None
    assert rows[0, "Cy Hurt"]["dnp"] and rows[0, "Cy Hurt"]["blesse"] and rows[0, "Cy Hurt"]["rejected"] == []
    assert {r["nom"]: r["rejected"] for r in read["rejected_players"].collect()} == {"Di Late": ["minute"], "Ed Typo": ["points"]}
    games = {r["team_idx"]: r for r in read["games"].collect()}
    assert games[1]["id_equipe"] == "PHI" and games[1]["periods"]["final"] == 11 and games[0]["periods"]["q4"] == 4
    assert read["teams"].filter("id_equipe = 'BOS'").first()["pt_subi_ctrattaq"] == 7.0


def test_pages_without_tables_are_rejected(spark, rows):
    pages = spark.createDataFrame([(D(2021, 1, 5), 3, "box", "<p>try again</p>")], "game_date date, game_no int, kind string, html string")
    read = day.read_day_pages(pages)
    assert rows(read["rejected_pages"], "game_no", "kind") == [(3, "box")] and read["players"].count() == 0


def stored(state, spark):
    """State with its rows fixed, so that a test does not recompute all that led to it."""
    return {name: spark.createDataFrame(df.collect(), schemas.STORED[name]) for name, df in state.items()}


KINDS = [(1, "cheville", "Ankle"), (2, "genou", "Knee"), (99, "inconnu", None)]


def first_day(spark):
    boston = [player("Al Ant", "30:00"), player("Bo Bee", "20:00"), out("Cy Cat", "DNP - Injury/Illness"), out("Di Dog", "DNP - Coach")]
    philly = [player("Ed Eel", "30:00"), player("Fo Fly", "10:00")]
    return day_pages(spark, "2021-01-05", [("BOS", "PHI", boston, philly)])


def second_day(spark):
    boston = [player("Al Ant", "30:00"), player("Cy Cat", "25:00"), out("Bo Bee", "DNP - Injury/Illness")]
    philly = [player("Ed Eel", "30:00")]
    lakers = [player("Fo Fly", "10:00"), player("Gu Gnu", "11:00")]
    miami = [player("Ha Hen", "12:00")]
    return day_pages(spark, "2021-01-08", [("PHI", "BOS", philly, boston), ("LAL", "MIA", lakers, miami)])


def check_final(state, rows):
    names = {r["id_joueur"]: r["nom_simple"] for r in state["joueur"].collect()}
    assert sorted(names.values()) == ["alant", "bobee", "cycat", "didog", "edeel", "fofly", "gugnu", "hahen"]
    assert sorted(names) == list(range(1, 9))
    assert rows(state["match"], "id_match", "equipe_exterieure", "equipe_domicile", "id_saison", "id_type_match") == [
        (1, "BOS", "PHI", 3, 0), (2, "PHI", "BOS", 3, 0), (3, "LAL", "MIA", 3, 0)]
    assert state["score_match"].count() == 30 and state["stats_equipes"].count() == 6
    named = lambda df, key, *columns: sorted(((names[r["id_joueur"]], *[r[c] for c in columns]) for r in df.collect()), key=str)
    assert named(state["contrat"], "id_contrat", "id_equipe", "date_debut_contrat", "date_fin_contrat") == [
        ("alant", "BOS", D(2021, 1, 5), None), ("bobee", "BOS", D(2021, 1, 5), None), ("cycat", "BOS", D(2021, 1, 5), None),
        ("edeel", "PHI", D(2021, 1, 5), None), ("fofly", "LAL", D(2021, 1, 8), None), ("fofly", "PHI", D(2021, 1, 5), D(2021, 1, 7)),
        ("gugnu", "LAL", D(2021, 1, 8), None), ("hahen", "MIA", D(2021, 1, 8), None)]
    assert named(state["blessure"], "id_blessure", "id_type_blessure", "date_blessure", "date_guerison") == [
        ("bobee", 99, D(2021, 1, 8), None), ("cycat", 99, D(2021, 1, 5), D(2021, 1, 7))]
    assert sorted(r["id_contrat"] for r in state["contrat"].collect()) == list(range(1, 9))
    facts = named(state["stats_joueur"], "", "id_match", "minute")
    assert ("cycat", 2, "00:25:00") in facts and len(facts) == 10


def test_import_of_days(spark, rows):
    """Both days at once, then the second once more; one after the other is in test_streaming."""
    two, empty = second_day(spark), day.empty_state(spark)
    both = day.process_days(day.read_day_pages(first_day(spark).unionByName(two)), empty)
    state = stored(day.next_state(empty, both), spark)
    check_final(state, rows)
    again = day.process_days(day.read_day_pages(two), state)
    check_final(stored(day.next_state(state, again), spark), rows)


def test_games_without_two_teams_are_left_out(spark, rows):
    games = spark.createDataFrame([(D(2021, 1, 5), 0, 0, "BOS", {"final": 1}), (D(2021, 1, 5), 1, 0, "LAL", {"final": 1}), (D(2021, 1, 5), 1, 1, "MIA", {"final": 2})],
                                  "game_date date, game_no int, team_idx int, id_equipe string, periods map<string,int>")
    assert rows(day.incomplete_games(games), "game_no", "n_teams") == [(0, 1)]


def injuries_of_day(spark, kinds):
    listed = spark.createDataFrame([
        ("B. Bee Bo Bee", "Fri, Jan 8", "Knee"),      # placed in the box score: takes the type
        ("E. Eel Ed Eel", "Wed, Jan 6", "ANKLE"),     # has played: from the day after the last game before
        ("D. Dog Di Dog", "Thu, Jan 7", "Ankle"),     # known, never played: the list's day
        ("Z. Zoo Zi Zoo", "Thu, Jan 7", "Ankle"),     # unknown
        ("A. Ant Al Ant", "Sat, Jan 9", "Ankle"),     # after the day imported
        ("F. Fly Fo Fly", "Fri, Jan 8", "Flu"),       # unknown injury
    ], "Player string, Updated string, Injury string")
    return injuries.normalize_injury_list(listed, kinds, D(2021, 1, 10), "2021-01-08")


def check_injuries(final):
    names = {r["id_joueur"]: r["nom_simple"] for r in final["joueur"].collect()}
    spells = sorted((names[r["id_joueur"]], r["id_type_blessure"], r["date_blessure"], r["date_guerison"]) for r in final["blessure"].collect())
    assert spells == [("bobee", 2, D(2021, 1, 8), None), ("cycat", 99, D(2021, 1, 5), D(2021, 1, 7)),
                      ("didog", 1, D(2021, 1, 7), None), ("edeel", 1, D(2021, 1, 6), None)]
    assert sorted(r["id_blessure"] for r in final["blessure"].collect()) == [1, 2, 3, 4]


def test_injury_list_completes_spells(spark, rows):
    empty = day.empty_state(spark)
    empty["enum_type_blessure"] = spark.createDataFrame(KINDS, schemas.STORED["enum_type_blessure"])
    state = stored(day.next_state(empty, day.process_days(day.read_day_pages(first_day(spark)), empty)), spark)
    normal = injuries_of_day(spark, state["enum_type_blessure"])
    assert rows(normal, "nom_simple", "id_type_blessure") == [("bobee", 2), ("didog", 1), ("edeel", 1), ("zizoo", 1)]
    outputs = day.process_days(day.read_day_pages(second_day(spark)), state, injury_list=normal)
    final = stored(day.next_state(state, outputs), spark)
    check_injuries(final)
    # The same list again adds nothing.
    known = final["joueur"].select("id_joueur", "nom_simple")
    facts = final["stats_joueur"].join(final["match"], "id_match").select("id_joueur", "date_match").join(known, "id_joueur")
    assert injuries.apply_injury_list(final["blessure"], known, normal, facts, final["enum_type_blessure"]).count() == 4


def test_picks(spark, rows):
    tables = spark.createDataFrame([
        (1, 0, False, 0, ["2021-01-01", "Al Ant"]), (1, 0, False, 1, ["2021-01-02", "Bo-Bee"]), (1, 1, False, 0, ["other", "table"]),
        (2, 0, False, 0, ["2021-01-03", "Zi Zoo"]), (2, 0, False, 1, ["2021-01-02", "Al Ant"]), (2, 0, False, 2, ["", "last row"])],
        "page_no int, table_idx int, is_header boolean, row_idx int, cells array<string>")
    players = spark.createDataFrame([(1, "alant"), (2, "bobee")], "id_joueur long, nom_simple string")
    known = spark.createDataFrame([(D(2021, 1, 2), 9), (D(2020, 1, 1), 1)], "date_choix date, id_joueur long")
    fresh = picks.new_picks(picks.pick_rows(tables), players, known, 7)
    # The second pick of player 1 falls on a known day of another player: gone, as both parts are known.
    assert rows(fresh) == [(D(2021, 1, 1), 1, 7), (D(2021, 1, 2), 2, 7)]


def test_profiles_and_dimensions(spark):
    base = ["6'9\" (2.06m)", "250lb (113kg)", "USA", "College"]
    rest = ["December 30, 1984", "2003 R1 Pick 1", "18 Years", "x", "x", "x", "x"]
    header = ["Lakers | #6 | Forward-Guard", "LeBron", "James", "Ask"]
    df = spark.createDataFrame([("a", base + rest, header), ("b", base + ["37 years"] + rest, header), ("c", [], header),
                                ("d", base, header)], "link string, values array<string>, header array<string>")
    found = {r["page_web"]: r for r in profiles.parse_profile(df).collect()}
    assert set(found) == {"a", "b", "d"}
    for link in "ab":
        r = found[link]
        assert (r["taille"], r["poids"], r["date_naissance"], r["draft"], r["experience"]) == (2.06, 113.0, D(1984, 12, 30), "2003 R1 Pick 1", "18 Years")
        assert (r["nom"], r["nom_simple"], r["id_position_terrain"]) == ("LeBron James", "lebronjames", "F-G")
    assert found["d"]["date_naissance"] is None
    assert profiles.player_dimension(df, links=df.select("link").filter("link = 'a'")).count() == 1
    teams = {r["id_equipe"]: r for r in profiles.team_dimension(spark).collect()}
    assert len(teams) == 30 and all(t["division"] and t["conference"] for t in teams.values())
    assert (teams["BOS"]["division"], teams["BOS"]["conference"], teams["LAL"]["conference"]) == ("Atlantic Division", "Est", "Ouest")
    assert profiles.position_dimension(spark).count() == 8


def test_marks_and_window(spark, rows):
    games = spark.createDataFrame([(D(2021, 1, 5),), (D(2021, 1, 3),)], "date_match date")
    planned = spark.createDataFrame([("A", "B", D(2021, 2, 1), 3), ("C", "D", D(2021, 2, 9), 2)], schemas.STORED["calendrier"])
    assert rows(schedule.high_water_marks(games, planned, D(2021, 2, 12))) == [
        (D(2021, 1, 5), D(2021, 2, 9), 3, D(2021, 1, 6), D(2021, 2, 10), 2)]
    assert rows(schedule.high_water_marks(games.limit(0), planned, D(2021, 2, 12)), "last_game", "last_season") == [(None, 3)]
    fresh = spark.createDataFrame([("X", "Y", D(2021, 2, 9), 3), ("X", "Y", D(2021, 2, 9), 3), ("Z", "Z", D(2021, 3, 1), 3)], schemas.STORED["calendrier"])
    assert rows(schedule.sync_window(planned, fresh, "date_match", "2021-02-05", "2021-02-20"), "equipe_exterieure") == [("A",), ("X",)]


def test_available(spark, rows):
    planned = spark.createDataFrame([("BOS", "PHI", D(2021, 2, 1), 3), ("LAL", "MIA", D(2021, 2, 2), 3)], schemas.STORED["calendrier"])
    contracts = spark.createDataFrame([(1, "BOS", None), (2, "PHI", None), (3, "PHI", None), (4, "LAL", None), (5, "BOS", D(2021, 1, 1)), (6, "BOS", None)],
                                      "id_joueur long, id_equipe string, date_fin_contrat date")
    hurt = spark.createDataFrame([(2, D(2021, 1, 1), None), (3, D(2021, 1, 1), D(2021, 1, 9))], "id_joueur long, date_blessure date, date_guerison date")
    picked = spark.createDataFrame([(6,)], "id_joueur long")
    players = spark.createDataFrame([(i, f"p{i}", "G") for i in range(1, 7)], "id_joueur long, nom string, id_position_terrain string")
    free = available(planned, contracts, players, hurt, picked, "2021-02-01", profiles.position_dimension(spark))
    assert rows(free, "id_joueur", "id_equipe", "adversaire") == [(1, "BOS", "PHI"), (3, "PHI", "BOS")]
    assert free.first()["nom_position_terrain"].startswith("Guard")
