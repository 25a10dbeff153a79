"""Import of game days: from pages to the stored tables.

State is a dict of frames named as in `schemas.STORED`; a job returns what to append and which tables
to replace, and never changes what it reads.
"""

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from courtledger import fixed_values as fv, schemas
from courtledger.operators.history import (event_spells_apply, event_spells_correct, observed_days, scd2_apply,
                                           scd2_correct)
from courtledger.operators.keys import allocate_ids, new_members
from courtledger.operators.matching import active_or_injured, resolve_key
from courtledger.operators.reshape import melt_map, pivot_pair
from courtledger.operators.skew import own_shuffle
from courtledger.plans.box_score import (GAME, game_tables, normalize_box_score, player_facts,
                                         rejected_games, rejected_rows, team_facts, team_tables)
from courtledger.plans.injuries import accepted, apply_injury_list, rejected
from courtledger.session import cut_lineage
from courtledger.sources.html import extract_html_tables
from courtledger.sources.tables import max_of, max_of_all


def read_day_pages(pages: DataFrame) -> dict:
    """Pages (game_date, game_no, kind, html) with kind "box" or "summary" to clean rows.

    Pages are parsed once; the table rows are stored before they are used several times.
    """
    tables = cut_lineage(extract_html_tables(pages, [*GAME, "kind"]))
    box, summary = (tables.filter(F.col("kind") == k) for k in ("box", "summary"))
    players = normalize_box_score(box)
    return {"players": players, "games": game_tables(summary), "teams": team_tables(summary),
            "rejected_players": rejected_rows(players),
            "rejected_pages": unread_pages(pages, tables)}


def unread_pages(pages: DataFrame, tables: DataFrame) -> DataFrame:
    """Pages of which no table row could be read, with or without a table in them."""
    key = [*GAME, "kind"]
    return pages.select(*key).distinct().join(own_shuffle(tables.select(*key).distinct()), key, "left_anti")


def incomplete_games(games: DataFrame) -> DataFrame:
    """Games for which a team is missing."""
    return games.groupBy(*GAME).agg(F.count(fv.TEAM_COLUMN).alias("n_teams")).filter("n_teams <> 2")


def dedup_games(games: DataFrame, stored: DataFrame) -> DataFrame:
    """Games whose date and teams are not stored yet, each once (the lowest number wins)."""
    teams = ["equipe_domicile", "equipe_exterieure"]
    once = games.groupBy("game_date", *teams).agg(F.min("game_no").alias("game_no"))
    known = stored.select(F.col("date_match").alias("game_date"), *teams)
    return once.join(known, ["game_date", *teams], "left_anti")


def empty_state(spark) -> dict:
    return {name: spark.createDataFrame([], schema) for name, schema in schemas.STORED.items()}


def conform(df: DataFrame, schema) -> DataFrame:
    """The declared columns in the declared types; missing ones are null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def _with_ids(changed: DataFrame, id_col, order, after) -> DataFrame:
    """Number the rows that have no id yet."""
    fresh = allocate_ids(changed.filter(F.col(id_col).isNull()), id_col, order, after)
    return changed.filter(F.col(id_col).isNotNull()).unionByName(fresh)


ID_COLUMNS = {"match": "id_match", "joueur": "id_joueur", "contrat": "id_contrat", "blessure": "id_blessure"}
GROUPS = ("joueur", "match", "contrat", "blesse", "stats", "rejects", "presence")


class _Import:
    """The steps of one import. Each is worked out when it is first asked for, and rows that several steps read are stored once."""

    def __init__(self, inputs, state, season, game_type, injury_list, last_ids, past_injuries, last_seen):
        self.inputs, self.state, self.season, self.game_type = inputs, state, season, game_type
        # A tagged list is read once, for the rows that are applied and for those that are reported.
        self.tagged = cut_lineage(injury_list) if injury_list is not None and "reason" in injury_list.columns else None
        self.injury_list = injury_list if self.tagged is None else accepted(self.tagged)
        self.past_injuries, self.last_seen = past_injuries, last_seen
        self.given_ids = dict(last_ids or {})

    @cached_property
    def last_ids(self):
        asked = {t: (self.state[t], c) for t, c in ID_COLUMNS.items() if t not in self.given_ids}
        found = max_of_all(asked)
        return {t: self.given_ids.get(t) or found.get(t) or 0 for t in ID_COLUMNS}

    @cached_property
    def games(self):
        pairs = pivot_pair(self.inputs["games"], GAME, "team_idx", fv.TEAM_COLUMN, ["equipe_exterieure", "equipe_domicile"])
        pairs = pairs.dropna(subset=["equipe_exterieure", "equipe_domicile"])
        return allocate_ids(dedup_games(pairs, self.state["match"]), "id_match", GAME, self.last_ids["match"])

    @cached_property
    def ids(self):
        return self.games.select("id_match", *GAME)

    @cached_property
    def rows(self):
        return self.inputs["players"].join(self.ids, GAME)

    @cached_property
    def members(self):
        return new_members(self.state["joueur"].select("id_joueur", "nom_simple"), self.rows, ["nom_simple"],
                           ["nom", "nom_simple"], "id_joueur", self.last_ids["joueur"])

    @cached_property
    def known(self):
        names = ["id_joueur", "nom_simple"]
        return self.state["joueur"].select(*names).unionByName(self.members.select(*names))

    @cached_property
    def listed(self):
        team_of = self.inputs["games"].select(*GAME, "team_idx", fv.TEAM_COLUMN)
        return cut_lineage(resolve_key(self.rows.filter(active_or_injured()), self.known, ["nom_simple"], "id_joueur")
                           .join(team_of, [*GAME, "team_idx"]))

    def joueur(self):
        return {"joueur": self.members}

    def match(self):
        match = self.games.select("id_match", F.lit(self.season).alias("id_saison"), F.col("game_date").alias("date_match"),
                                  "equipe_domicile", "equipe_exterieure", F.lit(self.game_type).alias("id_type_match"))
        periods = melt_map(self.inputs["games"].join(self.ids, GAME), [fv.TEAM_COLUMN, "id_match"], "periods", "id_periode", "score_periode")
        return {"match": match, "score_match": periods, "stats_equipes": team_facts(self.inputs["teams"].join(self.ids, GAME))}

    @cached_property
    def observed(self):
        """Stored days from the first day of this import on; if there are any, spells have to be corrected, not only carried on."""
        stored = self.state.get("presence")
        first = max_of(self.listed.agg(F.min("game_date").alias("d")), "d") if stored is not None else None
        if first is None:
            return None
        later = cut_lineage(stored.filter(F.col("date_match") >= F.lit(first)).withColumnRenamed("date_match", "game_date"))
        return None if later.isEmpty() else later

    @cached_property
    def contracts(self):
        """The change of the contracts, ids and all: (kept, changed, gone)."""
        args = ("id_joueur", fv.TEAM_COLUMN, "game_date", "date_debut_contrat", "date_fin_contrat", ["game_no", "team_idx"])
        if self.observed is None:
            change = scd2_apply(self.state["contrat"], self.listed, *args, store=cut_lineage)
        else:
            change = scd2_correct(self.state["contrat"], self.observed, self.listed, *args, store=cut_lineage)
        return self._numbered(change, "contrat", ["id_joueur", "date_debut_contrat"])

    def _numbered(self, change, name, order):
        kept, changed, gone = change.parts()
        id_col = ID_COLUMNS[name]
        return kept, _with_ids(conform(changed, schemas.STORED[name]), id_col, order, self.last_ids[name]), gone

    def contrat(self):
        kept, changed, _ = self.contracts
        return {"contrat": conform(kept, schemas.STORED["contrat"]).unionByName(changed)}

    @cached_property
    def injuries(self):
        args = ("id_joueur", "blesse", "game_date", "date_blessure", "date_guerison", {"id_type_blessure": fv.UNKNOWN_INJURY_TYPE})
        if self.observed is None:
            change = event_spells_apply(self.state["blessure"], self.listed, *args, store=cut_lineage)
        else:
            change = event_spells_correct(self.state["blessure"], self.observed, self.listed, *args, store=cut_lineage)
        order = ["id_joueur", "date_blessure", "id_type_blessure"]
        if self.injury_list is None:
            return self._numbered(change, "blessure", order)
        old, schema = self.state["blessure"], schemas.STORED["blessure"]
        spells = apply_injury_list(change.all(), self.known, self.injury_list, self._facts(), self.state["enum_type_blessure"],
                                   store=cut_lineage, past=self.past_injuries)
        spells = cut_lineage(conform(spells, schema))
        was = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in schema.fieldNames()]
        # Rows that are stored just so have not changed; those without an id are new.
        stored = conform(old, schema).filter("id_blessure IS NOT NULL").alias("o")
        kept, changed = (spells.alias("n").join(own_shuffle(stored), was, how) for how in ("left_semi", "left_anti"))
        return kept, _with_ids(changed, "id_blessure", order, self.last_ids["blessure"]), change.parts()[2]

    def blesse(self):
        kept, changed, _ = self.injuries
        return {"blessure": conform(kept, schemas.STORED["blessure"]).unionByName(changed)}

    def changes(self):
        """The rows of contracts and injuries that are new or different, and those that are no more."""
        return {f"{name}_{what}": rows for name, found in (("contrat", self.contracts), ("blessure", self.injuries))
                for what, rows in (("changed", found[1]), ("gone", found[2]))}

    def presence(self):
        teams = observed_days(self.listed, "id_joueur", fv.TEAM_COLUMN, "game_date", ["game_no", "team_idx"])
        hurt = observed_days(self.listed, "id_joueur", "blesse", "game_date")
        return {"presence": teams.join(hurt, ["id_joueur", "game_date"]).withColumnRenamed("game_date", "date_match")}

    def _facts(self):
        """Last game day per player; the list is read on the last day, before that day's player facts are stored."""
        seen = self.last_seen
        if seen is None:
            seen = (self.state["stats_joueur"].select("id_joueur", "id_match").join(self.state["match"].select("id_match", "date_match"), "id_match")
                    .groupBy("id_joueur").agg(F.max("date_match").alias("date_match")))
        today = self.listed.filter(~F.col("dnp")).select("id_joueur", F.col("game_date").alias("date_match"))
        last_day = max_of(self.games, "game_date")
        if last_day is not None:
            today = today.filter(F.col("date_match") < F.lit(last_day))
        return seen.select("id_joueur", "date_match").unionByName(today).join(self.known, "id_joueur")

    def stats(self):
        return {"stats_joueur": player_facts(self.listed)}

    def rejects(self):
        place = [*GAME, "team_idx", "row_idx", "nom"]
        players = self.inputs.get("rejected_players")
        pages = self.inputs.get("rejected_pages")
        empty = lambda name: self.inputs["games"].sparkSession.createDataFrame([], schemas.REJECTS[name])
        return {"rejected_rows": empty("rejected_rows") if players is None else players.select(*place, F.array_join("rejected", ",").alias("rejected")),
                "rejected_games": rejected_games(self.inputs["games"], self.inputs["teams"]),
                "rejected_injuries": empty("rejected_injuries") if self.tagged is None else rejected(self.tagged),
                "rejected_pages": empty("rejected_pages") if pages is None else pages}


def process_days(inputs: dict, state: dict, season=fv.DEFAULT_SEASON, game_type=fv.REGULAR_SEASON,
                 injury_list: DataFrame | None = None, last_ids: dict | None = None,
                 past_injuries: DataFrame | None = None, groups=GROUPS, last_seen: DataFrame | None = None) -> dict:
    """Any number of game days at once.

    inputs: frames as from `read_day_pages`; injury_list as from `normalize_injury_list`, or as from `tag_injuries` to have
    its rejects reported, applied after the last day.
    Returns groups of frames: "match", "stats", "presence" (what was seen of players by day) and new players to append; "contrat"
    and "blesse" as whole new tables, or "changes", their changed rows alone; and "rejects", what was left out and why. Only the
    groups asked for are worked out. Games that are stored already are skipped, so importing a day twice changes
    nothing. Days may come in any order if the state has the "presence" of those before.

    The state may hold the open contracts and injuries alone; then the greatest ids given so far have to
    be named in last_ids, by table, and with an injury list the ended injuries in past_injuries. last_seen (player, last
    game day) stands for all stored facts. Games without two teams are left out and reported.
    """
    work = _Import(inputs, state, season, game_type, injury_list, last_ids, past_injuries, last_seen)
    declared = {**schemas.STORED, **schemas.REJECTS}
    schema = lambda name: declared[name.removesuffix("_changed").removesuffix("_gone")]
    return {group: {name: conform(df, schema(name)) for name, df in getattr(work, group)().items()} for group in groups}


REPLACED = ("contrat", "blessure")


def next_state(state: dict, outputs: dict) -> dict:
    """State after the outputs of `process_days`."""
    new = dict(state)
    for name, df in ((n, df) for group, tables in outputs.items() if group not in ("rejects", "changes") for n, df in tables.items()):
        new[name] = df if name in REPLACED else state[name].unionByName(df)
    return new
