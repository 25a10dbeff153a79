"""Injury lists, and how they complete the injury spells seen in box scores."""

from pyspark.sql import DataFrame, functions as F

from courtledger import fixed_values as fv
from courtledger.functions.temporal import day_after, infer_year
from courtledger.functions.text import name_tail, normalize_name
from courtledger.operators.matching import drop_members, latest_per_key, update_from
from courtledger.operators.skew import own_shuffle


def normalize_injury_list(rows: DataFrame, kinds: DataFrame, ref, max_date,
                          name="Player", updated="Updated", injury="Injury",
                          kind_id="id_type_blessure", kind_name="nom_blessure_anglais") -> DataFrame:
    """Names, injury types and dates of a scraped list, up to max_date; unknown injuries drop out."""
    known = kinds.select(F.lower(kind_name).alias(injury), kind_id)
    named = rows.withColumns({name: name_tail(name), injury: F.lower(injury)})
    named = named.withColumns({"nom_simple": normalize_name(name),
                               "date_blessure": infer_year(updated, ref)})
    return named.join(known, injury).filter(F.col("date_blessure") <= F.to_date(F.lit(max_date)))


def rejected_injuries(rows: DataFrame, kinds: DataFrame, ref, name="Player", updated="Updated", injury="Injury",
                      kind_name="nom_blessure_anglais") -> DataFrame:
    """Rows of a scraped list that `normalize_injury_list` leaves out whatever the last day is, with the reason."""
    known = kinds.select(F.lower(kind_name).alias("_kind")).distinct()
    marked = rows.join(own_shuffle(known.withColumn("_known", F.lit(True))), F.lower(injury) == F.col("_kind"), "left")
    reason = F.when(infer_year(updated, ref).isNull(), "date").when(F.col("_known").isNull(), "injury").when(F.col(name).isNull(), "name")
    return marked.select(*rows.columns, reason.alias("reason")).filter(F.col("reason").isNotNull())


def tag_injuries(rows: DataFrame, kinds: DataFrame, ref, max_date, name="Player", updated="Updated", injury="Injury",
                 kind_id="id_type_blessure", kind_name="nom_blessure_anglais") -> DataFrame:
    """Every row of a scraped list in one pass: as `normalize_injury_list` gives it, with `reason`, null for accepted rows.

    Reasons: "name", "date" (not readable), "later" (after max_date), "injury" (in no kind). Of kinds with the same name the
    lowest id counts, so that rows in are rows out.
    """
    known = own_shuffle(kinds.groupBy(F.lower(kind_name).alias("_kind")).agg(F.min(kind_id).alias(kind_id)).filter("_kind IS NOT NULL"))
    tagged = rows.select("*", infer_year(updated, ref).alias("date_blessure"), F.lower(injury).alias("_injury")).join(known, F.col("_injury") == F.col("_kind"), "left")
    reason = (F.when(F.col(name).isNull(), "name").when(F.col("date_blessure").isNull(), "date")
              .when(F.col("date_blessure") > F.to_date(F.lit(max_date)), "later").when(F.col("_kind").isNull(), "injury"))
    return tagged.withColumns({"nom_simple": normalize_name(name_tail(name)), "reason": reason}).drop("_kind", "_injury")


def accepted(tagged: DataFrame, name="Player", injury="Injury") -> DataFrame:
    """The accepted rows, as an injury list."""
    return tagged.filter("reason IS NULL").withColumns({name: name_tail(name), injury: F.lower(injury)}).drop("reason")


def rejected(tagged: DataFrame, name="Player", updated="Updated", injury="Injury") -> DataFrame:
    """The other rows, as they came, with the reason."""
    return tagged.filter("reason IS NOT NULL").select(F.col(name).alias("Player"), F.col(updated).alias("Updated"), F.col(injury).alias("Injury"), "reason")


def open_names(spells: DataFrame, members: DataFrame, kind=None, key="id_joueur", name="nom_simple",
               kind_id="id_type_blessure", end="date_guerison") -> DataFrame:
    """Names of members with an open spell (of a kind that satisfies the condition)."""
    spells = spells.filter(F.col(end).isNull())
    if kind is not None:
        spells = spells.filter(kind(F.col(kind_id)))
    return spells.select(key).join(members.select(key, name), key).select(name)


def fill_placeholder_kind(spells: DataFrame, members: DataFrame, listed: DataFrame, key="id_joueur",
                          name="nom_simple", kind_id="id_type_blessure", end="date_guerison",
                          start="date_blessure", placeholder=fv.UNKNOWN_INJURY_TYPE) -> DataFrame:
    """Open spells of the placeholder kind take the kind listed for that name; the latest entry wins."""
    waiting = F.col(end).isNull() & F.col(kind_id).eqNullSafe(F.lit(placeholder))
    kinds = listed.join(members.select(key, name), name).select(
        key, F.col(kind_id).cast(spells.schema[kind_id].dataType).alias(kind_id), start)
    updated = update_from(spells.filter(waiting), kinds, [key], [kind_id], order=[start, kind_id])
    return spells.filter(~waiting).unionByName(updated)


def unseen_with_history(listed: DataFrame, excluded: DataFrame, facts: DataFrame, kinds: DataFrame,
                        existing: DataFrame, *, name, key, day, kind, kind_name, kind_id, start) -> DataFrame:
    """New spells for listed names without an open one that do appear in the facts.

    listed (name, kind), excluded (name), facts (name, key, day), kinds (kind_name, kind_id),
    existing (key, start), or a function that gives it for a frame of keys, so that only the candidates' rows are
    looked up. A spell starts the day after the last fact, and is left out if it exists. The facts are reduced
    to one row per member before anything is joined to them.
    """
    unseen = drop_members(listed, excluded, [name])
    last = facts.groupBy(key, name).agg(F.max(F.col(day).cast("date")).alias(day))
    met = unseen.select(name, kind).join(last, name).select(key, day, kind)
    latest = latest_per_key(met, [key], [day, kind]).withColumn(start, day_after(day))
    typed = latest.join(kinds.select(F.lower(kind_name).alias("_kind"), kind_id),
                        F.lower(kind) == F.col("_kind"))
    candidates = typed.select(key, start, kind_id)
    if callable(existing):
        existing = existing(candidates.select(key).distinct())
    return drop_members(candidates, existing, [key, start], hot=False)


def unseen_without_history(listed: DataFrame, excluded: DataFrame, members: DataFrame, *,
                           name, key, columns) -> DataFrame:
    """New spells, with the list's own data, for listed names without an open spell."""
    return drop_members(listed, excluded, [name]).join(members.select(key, name), name).select(key, *columns)


def apply_injury_list(spells: DataFrame, members: DataFrame, listed: DataFrame, facts: DataFrame,
                      kinds: DataFrame, store=lambda df: df, past: DataFrame | None = None) -> DataFrame:
    """The three steps in their order: complete placeholders, add those with history, add the rest.

    facts: (nom_simple, id_joueur, date_match). Past spells are passed through, or given as `past` if
    they are stored elsewhere; `store` keeps the open ones and the additions from being computed again.
    New rows have no id yet.
    """
    other_kind = lambda kind: kind != fv.UNKNOWN_INJURY_TYPE
    key, start, kind, end = "id_joueur", "date_blessure", "id_type_blessure", "date_guerison"
    is_open = F.col(end).isNull()
    existing = spells.select(key, start)
    if past is not None:
        existing = existing.unionByName(past.select(key, start))
    still_open = store(fill_placeholder_kind(spells.filter(is_open), members, listed))
    met = store(unseen_with_history(
        listed, open_names(still_open, members, other_kind), facts, kinds, existing,
        name="nom_simple", key=key, day="date_match", kind="Injury",
        kind_name="nom_blessure_anglais", kind_id=kind, start=start))
    still_open = still_open.unionByName(met, allowMissingColumns=True)
    unmet = unseen_without_history(
        listed, open_names(still_open, members, other_kind), members,
        name="nom_simple", key=key, columns=[start, kind])
    return spells.filter(~is_open).unionByName(still_open).unionByName(unmet, allowMissingColumns=True)
