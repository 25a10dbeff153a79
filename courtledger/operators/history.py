"""Validity spells: periods in which an attribute of a member kept its value, or an event lasted.

A batch may hold any number of days. It is first reduced to one row per member and day, so that
everything ordered by day works on groups no longer than the calendar, whatever the row counts.
State goes in and out as whole frames: old spells and a batch give new spells. The reduced batch is
used several times; `store`, if given, keeps it from being computed anew each time.

`scd2_apply` and `event_spells_apply` need batches in the order of their days. `scd2_correct` and
`event_spells_correct` take days in any order: spells alone do not say which days between their ends
were seen, so they also read the stored days (`observed_days` of earlier batches) from each member's
first day of the batch on. Whatever the order of arrival, the outcome is that of building from all days.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F

from courtledger.functions.temporal import day_before
from courtledger.operators.skew import own_shuffle


class SpellChange(NamedTuple):
    """Spells after a batch: those that had ended before, those that were open, and the new ones."""
    past: DataFrame     # untouched
    carried: DataFrame  # open before; some have an end now
    opened: DataFrame   # new; open, or already closed within the batch
    end: str            # name of the end column

    def all(self) -> DataFrame:
        return (self.past.unionByName(self.carried)
                         .unionByName(self.opened, allowMissingColumns=True))

    def closed(self) -> DataFrame:
        return self.carried.filter(F.col(self.end).isNotNull())

    def parts(self):
        """(kept, changed, gone), as of a Correction: the open ones that go on are kept."""
        kept = self.past.unionByName(self.carried.filter(F.col(self.end).isNull()))
        return kept, self.closed().unionByName(self.opened, allowMissingColumns=True), self.past.limit(0)


class Correction(NamedTuple):
    """Spells after a batch whose days may lie anywhere."""
    kept: DataFrame     # as they were
    changed: DataFrame  # new ones, and those with another start or end; these keep their other columns
    gone: DataFrame     # stored spells that are no spell any more, or part of another one
    moved: DataFrame    # stored spells that live on in a changed one with another start, as they were

    def all(self) -> DataFrame:
        return self.kept.unionByName(self.changed)

    def parts(self):
        return self.kept, self.changed, self.gone


def day_state(rows: DataFrame, key, value, day, order=None) -> DataFrame:
    """One row per (key, day) with the value of the row greatest in `order` (or the greatest value)."""
    state = (F.max_by(value, F.struct(*[F.col(c) for c in order])) if order else F.max(value))
    return (rows.filter(F.col(key).isNotNull())
                .groupBy(key, F.col(day).cast("date").alias(day)).agg(state.alias(value)))


def runs(states: DataFrame, key, value, day) -> DataFrame:
    """Consecutive days of the same value: (key, value, _from, _next, _first).

    _from is the first day, _next the first day of the following run, _first marks the first run.
    """
    by_day = Window.partitionBy(key).orderBy(day)
    before = states.withColumn("_first", F.row_number().over(by_day) == 1)
    before = before.withColumn("_before", F.lag(value).over(by_day))
    starts = before.filter(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before")))
    return starts.select(key, value, F.col(day).alias("_from"),
                         F.lead(day).over(by_day).alias("_next"), "_first")


def scd2_build(history: DataFrame, key, attr, day, start, end, order=None) -> DataFrame:
    """Spells of a whole history: (key, attr, start, end); the last one of a key stays open."""
    found = runs(day_state(history, key, attr, day, order), key, attr, day)
    return found.select(key, attr, F.col("_from").alias(start), day_before("_next").alias(end))


def scd2_apply(spells: DataFrame, batch: DataFrame, key, attr, day, start, end, order=None,
               store=lambda df: df) -> SpellChange:
    """Carry a batch of days into existing spells.

    A member whose open spells all differ from the first value of the batch gets them closed the day
    before and a new one opened; an equal open spell goes on until the value changes within the
    batch. Several stale open spells are all closed, and one is opened.
    """
    found = store(runs(day_state(batch, key, attr, day, order), key, attr, day))
    return _apply(spells, found, key, start, end,
                  goes_on=lambda spell, run: spell[attr].eqNullSafe(run[attr]),
                  opens=F.lit(True), columns={attr: F.col(attr)})


def event_spells_build(rows: DataFrame, key, flag, day, start, end) -> DataFrame:
    """Spells of days with the flag set, each ending the day before the first day without it."""
    found = runs(day_state(rows, key, flag, day), key, flag, day)
    return found.filter(F.col(flag)).select(key, F.col("_from").alias(start), day_before("_next").alias(end))


def event_spells_apply(spells: DataFrame, batch: DataFrame, key, flag, day, start, end,
                       constants=None, store=lambda df: df) -> SpellChange:
    """Open a spell on the first flagged day of a member without one; close all its open spells, of
    whatever kind, the day before its first day without the flag. Members not in the batch keep theirs.
    """
    found = store(runs(day_state(batch, key, flag, day), key, flag, day))
    return _apply(spells, found, key, start, end,
                  goes_on=lambda spell, run: run[flag],
                  opens=F.col(flag), columns={c: F.lit(v) for c, v in (constants or {}).items()})


def _apply(spells, found, key, start, end, goes_on, opens, columns):
    open_spells, past = spells.filter(F.col(end).isNull()), spells.filter(F.col(end).isNotNull())
    value = [c for c in found.columns if c not in (key, "_from", "_next", "_first")]
    first = found.filter("_first").select(
        F.col(key).alias("_key"), *[F.col(c).alias(f"_run_{c}") for c in value], "_from", "_next")
    first = own_shuffle(first)
    joined = open_spells.join(first, open_spells[key] == first["_key"], "left")
    run = {c: first[f"_run_{c}"] for c in value}
    going = goes_on(open_spells, run)
    new_end = F.when(F.col("_from").isNotNull(), F.when(
        going, day_before("_next")).otherwise(day_before("_from")))
    carried = joined.select(*[new_end.alias(end) if c == end else open_spells[c] for c in spells.columns])
    # An open spell that goes on makes its member's first run a continuation, not a new spell.
    continued = joined.filter(F.col("_from").isNotNull() & going).select(
        F.col(key), F.lit(True).alias("_first")).distinct()
    opened = (found.join(continued, [key, "_first"], "left_anti").filter(opens)
                   .select(key, *[c.alias(n) for n, c in columns.items()],
                           F.col("_from").alias(start), day_before("_next").alias(end)))
    return SpellChange(past, carried, opened, end)


def observed_days(rows: DataFrame, key, value, day, order=None) -> DataFrame:
    """What has to be stored of a batch: one row per (key, day), the greatest in `order`, with its value and order."""
    order = list(order or [])
    greatest = F.max(F.struct(*order, value)) if order else F.max(F.struct(value))
    days = (rows.filter(F.col(key).isNotNull()).groupBy(key, F.col(day).cast("date").alias("_day")).agg(greatest.alias("_row")))
    return days.select(key, F.col("_day").alias(day), *[F.col(f"_row.{c}").alias(c) for c in [value, *(c for c in order if c != day)]])


def scd2_correct(spells: DataFrame, observed: DataFrame, batch: DataFrame, key, attr, day, start, end, order=None,
                 store=lambda df: df) -> Correction:
    """Carry days of any time into existing spells.

    observed: the days that led to the spells, as `observed_days` gives them, with or without those before the
    members' first days of the batch, and with or without doubles. A spell goes on as the earliest
    stored one of its value that begins within it, and keeps that one's other columns.
    """
    return _correct(spells, observed, store(observed_days(batch, key, attr, day, order)), key, attr, day, start, end, order,
                    value_of=F.col(attr), same=F.col(f"n.{attr}").eqNullSafe(F.col(f"o.{attr}")),
                    holds=F.lit(True), columns={attr: F.col(attr)}, store=store)


def event_spells_correct(spells: DataFrame, observed: DataFrame, batch: DataFrame, key, flag, day, start, end,
                         constants=None, store=lambda df: df) -> Correction:
    """The same for events. A stored spell counts as seen on its first day, if no row says otherwise: so spells
    from other sources than the rows stay until a day without the flag.
    """
    return _correct(spells, observed, store(observed_days(batch, key, flag, day)), key, flag, day, start, end, None,
                    value_of=F.lit(True), same=F.lit(True),
                    holds=F.col(flag), columns={c: F.lit(v) for c, v in (constants or {}).items()}, store=store)


def _correct(spells, observed, days, key, value, day, start, end, order, value_of, same, holds, columns, store):
    order = [c for c in order or [] if c != day]
    first = own_shuffle(days.groupBy(key).agg(F.min(day).alias("_first")))
    marked = spells.join(first, key, "left")
    # A spell that ended before the day before a member's first day cannot change any more.
    reached = F.col("_first").isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.date_sub("_first", 1)))
    reached = F.coalesce(reached, F.lit(False))
    untouched = marked.filter(~reached).select(*spells.columns)
    touched = store(marked.filter(reached).select(*spells.columns))
    # The days of the members from their first day of the batch on, and the first days of their spells: within a spell,
    # what was seen before that day does not matter.
    row = lambda df, weight: df.select(F.col(key), F.col(day), F.struct(F.lit(weight).alias("_weight"), *order, value).alias("_row"))
    seen = observed.join(first, key).filter(F.col(day) >= F.col("_first"))
    began = touched.select(F.col(key), F.col(start).alias(day), *[F.lit(None).cast(days.schema[c].dataType).alias(c) for c in order], value_of.alias(value))
    states = (row(days, 1).unionByName(row(seen, 1)).unionByName(row(began, 0)).groupBy(key, day).agg(F.max("_row").alias("_row"))
              .select(key, day, F.col(f"_row.{value}").alias(value)))
    found = runs(states, key, value, day).filter(holds)
    found = store(found.select(key, value, F.col("_from").alias("_start"), day_before("_next").alias("_end"), *[c.alias(f"_new_{n}") for n, c in columns.items()]))
    # The earliest stored spell of the same value that begins within a new one lives on in it.
    old, new = touched.alias("o"), found.alias("n")
    begins_within = (F.col(f"o.{start}") >= F.col("n._start")) & (F.col("n._end").isNull() | (F.col(f"o.{start}") <= F.col("n._end")))
    within = new.join(old, (F.col(f"o.{key}") == F.col(f"n.{key}")) & begins_within & same, "left")
    rest = [c for c in spells.columns if c not in (key, start, end)]
    heirs = within.groupBy(F.col(f"n.{key}").alias(key), F.col("n._start").alias("_start"), F.col("n._end").alias("_end"),
                           *[F.col(f"n._new_{c}").alias(f"_new_{c}") for c in columns]).agg(
        F.min(F.when(F.col(f"o.{start}").isNotNull(), F.struct(f"o.{start}", f"o.{end}", *[f"o.{c}" for c in rest]))).alias("_old"))
    heirs = store(heirs)
    has_old = F.col("_old").isNotNull()
    fresh = lambda c: F.col(f"_new_{c}") if c in columns else F.lit(None)
    out = [F.col(key) if c == key else F.col("_start").alias(c) if c == start else F.col("_end").alias(c) if c == end
           else F.when(has_old, F.col(f"_old.{c}")).otherwise(fresh(c)).cast(spells.schema[c].dataType).alias(c) for c in spells.columns]
    as_it_was = has_old & (F.col("_start") == F.col(f"_old.{start}")) & F.col("_end").eqNullSafe(F.col(f"_old.{end}"))
    as_it_was = F.coalesce(as_it_was, F.lit(False))
    live = heirs.filter(has_old).select(F.col(key), F.struct(f"_old.{start}", f"_old.{end}", *[f"_old.{c}" for c in rest]).alias("_it"))
    every = touched.withColumn("_it", F.struct(start, end, *rest))
    gone = every.join(own_shuffle(live.withColumnsRenamed({key: "_k", "_it": "_live"})), (F.col(key) == F.col("_k")) & F.col("_it").eqNullSafe(F.col("_live")), "left_anti")
    before = [F.col(key) if c == key else F.col(f"_old.{c}").alias(c) for c in spells.columns]
    return Correction(untouched.unionByName(heirs.filter(as_it_was).select(*out)), heirs.filter(~as_it_was).select(*out), gone.select(*spells.columns),
                      heirs.filter(has_old & (F.col("_start") != F.col(f"_old.{start}"))).select(*before))


def last_spell(spells: DataFrame, days: DataFrame, key, day, start) -> DataFrame:
    """The days with `_last`, the spell of their member that began last, on the day or before; null if there is none.

    Spells that began on the same day: the one that is greatest by its other columns.
    """
    columns = [c for c in spells.columns if c not in (key, start)]
    asked = days.select(key, day).distinct()
    began = spells.select(F.col(key).alias("_key"), F.struct(start, *columns).alias("_spell"))
    last = (asked.join(began, (F.col(key) == F.col("_key")) & (F.col(f"_spell.{start}") <= F.col(day)))
            .groupBy(key, day).agg(F.max("_spell").alias("_last")))
    return days.join(own_shuffle(last), [key, day], "left")


def decide(spells: DataFrame, days: DataFrame, key, attr, day, start, end, kind="guaranteed") -> DataFrame:
    """What a day says about a member's spell: (key, day, attr, decision, before, close_on, kind).

    new: the member never had a spell; same: the one that is open on the day has this value; change: it has another, is closed the
    day before, and a spell of the given kind begins; return: the last one has ended before, and one of that kind begins. `before`
    is the value of the last spell.
    """
    found = last_spell(spells, days.select(key, F.col(day).cast("date").alias(day), attr), key, day, start)
    last = lambda c: F.col(f"_last.{c}")
    is_open = last(end).isNull() | (last(end) >= F.col(day))
    decision = (F.when(F.col("_last").isNull(), "new").when(~is_open, "return").when(last(attr).eqNullSafe(F.col(attr)), "same").otherwise("change"))
    found = found.withColumn("decision", decision)
    return found.select(key, day, attr, "decision", last(attr).alias("before"), F.when(F.col("decision") == "change", day_before(day)).alias("close_on"),
                        F.when(F.col("decision").isin("change", "return"), kind).alias("kind"))
