"""Spells over events and orders."""

from pyspark.sql import functions as F, types as T

from courtledger.catalog.base import date, registry, table
from courtledger.operators.history import (event_spells_apply as event_apply, event_spells_build, event_spells_correct, decide, observed_days,
                                           scd2_apply, scd2_build, scd2_correct)
from courtledger.operators.matching import drop_members
from courtledger.operators.rollup import finished, fold_parts, grouping_sets, partial_stats, read_parts, store_parts
from courtledger.plans.schedule import high_water_marks as marks_op, sync_stored_window, sync_window as sync_op
from courtledger.session import cut_lineage, scratch_path
from courtledger.sources.manifest import publish_once, read_published
from courtledger.sources.tables import date_series as series_op
from courtledger.streaming.ingest import any_order_step, dedup_stream as dedup_op, ingest_stream, read_state, spell_state

QUERIES, SQL, query = registry()

_TYPE_SPELLS = """
    WITH states AS (
        SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY ALL),
    marked AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before FROM states)
    SELECT user_id, event_type, day AS start_day, lead(day) OVER (PARTITION BY user_id ORDER BY day) - 1 AS end_day
    FROM marked WHERE before IS NULL OR before <> event_type"""

_ERROR_SPELLS = """
    WITH states AS (SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS hurt FROM events GROUP BY ALL),
    marked AS (SELECT *, lag(hurt) OVER (PARTITION BY user_id ORDER BY day) AS before FROM states),
    runs AS (SELECT user_id, hurt, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next_day
             FROM marked WHERE before IS NULL OR before <> hurt)
    SELECT user_id, day AS start_day, next_day - 1 AS end_day FROM runs WHERE hurt"""


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", date("ts").alias("day"),
                                             (F.col("event_type") == "error").alias("hurt"))


def _split(events):
    """Stored and new days."""
    cut = F.to_date(F.lit("2024-01-16"))
    return events.filter(F.col("day") < cut), events.filter(F.col("day") >= cut)


@query(_TYPE_SPELLS)
def spells_build(spark, sf):
    return scd2_build(_events(spark, sf), "user_id", "event_type", "day", "start_day", "end_day", ["ts", "event_id"])


@query(_TYPE_SPELLS)
def spells_apply(spark, sf):
    """Half of the days carried into the spells of the other half give the spells of all days."""
    stored, batch = _split(_events(spark, sf))
    args = ("user_id", "event_type", "day", "start_day", "end_day", ["ts", "event_id"])
    return scd2_apply(scd2_build(stored, *args), batch, *args).all()


@query(_ERROR_SPELLS)
def event_spells(spark, sf):
    return event_spells_build(_events(spark, sf), "user_id", "hurt", "day", "start_day", "end_day")


@query(_ERROR_SPELLS)
def event_spells_carried(spark, sf):
    stored, batch = _split(_events(spark, sf))
    args = ("user_id", "hurt", "day", "start_day", "end_day")
    return event_apply(event_spells_build(stored, *args), batch, *args).all()


#: Batches into which rows are dealt, whatever their days: every batch but the first brings days before stored ones, and more rows of stored days.
_BATCHES = 3


def _shuffled(events):
    return [events.filter(F.pmod(F.xxhash64("event_id"), F.lit(_BATCHES)) == k) for k in range(_BATCHES)]


@query(_TYPE_SPELLS)
def spells_late(spark, sf):
    """Batches that arrive in no order give the spells of all days."""
    args, order = ("user_id", "event_type", "day", "start_day", "end_day"), ["ts", "event_id"]
    first, *later = _shuffled(_events(spark, sf))
    spells, seen = cut_lineage(scd2_build(first, *args, order)), cut_lineage(observed_days(first, *args[:3], order))
    for batch in later:
        days = cut_lineage(observed_days(batch, *args[:3], order))
        spells = cut_lineage(scd2_correct(spells, seen, days, *args, order, store=cut_lineage).all())
        seen = seen.unionByName(days)
    return spells


@query(_ERROR_SPELLS)
def event_spells_late(spark, sf):
    args = ("user_id", "hurt", "day", "start_day", "end_day")
    first, *later = _shuffled(_events(spark, sf))
    spells, seen = cut_lineage(event_spells_build(first, *args)), cut_lineage(observed_days(first, *args[:3]))
    for batch in later:
        days = cut_lineage(observed_days(batch, *args[:3]))
        spells = cut_lineage(event_spells_correct(spells, seen, days, *args, store=cut_lineage).all())
        seen = seen.unionByName(days)
    return spells


@query(_TYPE_SPELLS)
def stream_ingest(spark, sf):
    """The spells again, from a file stream of several batches, whose days come in no order: a batch writes the spells that it changes."""
    names = ["event_id", "ts", "user_id", "event_type"]
    events = table(spark, sf, "events").select(*names)
    root = scratch_path(spark, "stream")
    for part in _shuffled(events):
        part.coalesce(1).write.mode("append").parquet(f"{root}/incoming")
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/incoming").withColumn("day", date("ts")))
    spells = T.StructType([events.schema["user_id"], events.schema["event_type"], T.StructField("start_day", T.DateType()), T.StructField("end_day", T.DateType())])
    state = spell_state(spells, "user_id", "start_day", "end_day")
    step = any_order_step(f"{root}/tables", "user_id", "event_type", "day", "start_day", "end_day", ["ts", "event_id"])
    ingest_stream(stream, f"{root}/tables", state, step, f"{root}/checkpoint").awaitTermination()
    return read_state(spark, f"{root}/tables", state)["spells"]


@query("""
    SELECT max(CAST(o_orderdate AS DATE)) AS last_game, (SELECT max(CAST(ts AS DATE)) FROM events) AS last_scheduled,
           (SELECT max(CAST(year(ts) AS INTEGER)) FROM events) AS last_season, max(CAST(o_orderdate AS DATE)) + 1 AS next_game,
           (SELECT max(CAST(ts AS DATE)) + 1 FROM events) AS next_scheduled,
           (SELECT CAST(DATE '2024-03-01' - (max(CAST(ts AS DATE)) + 1) AS INTEGER) FROM events) AS days_to_import FROM orders""")
def high_water_marks(spark, sf):
    schedule = table(spark, sf, "events").select("ts", F.year("ts").alias("season"))
    return marks_op(table(spark, sf, "orders"), schedule, F.to_date(F.lit("2024-03-01")),
                    game_day="o_orderdate", schedule_day="ts", season="season")


_BIG_DAYS = "o_totalprice > 480000"


@query(f"""
    SELECT CAST(d AS DATE) AS day, strftime(d, '%Y-%m-%d') AS day_text
    FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)
    WHERE CAST(d AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE {_BIG_DAYS})""")
def missing_days(spark, sf):
    """Days of the stored span without a very large order."""
    orders = table(spark, sf, "orders")
    span = orders.agg(F.min(date("o_orderdate")).alias("a"), F.max(date("o_orderdate")).alias("b")).first()
    series = series_op(spark, span["a"], (span["b"] - span["a"]).days + 1)
    return drop_members(series, orders.filter(_BIG_DAYS).select(date("o_orderdate").alias("day")), ["day"], hot=False)


@query("""
    SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
    UNION ALL
    SELECT DISTINCT l_orderkey, l_linestatus, CAST(l_shipdate AS DATE) FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'""")
def sync_window(spark, sf):
    """The rows of one year replaced by those of another source."""
    stored = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", date("o_orderdate").alias("day"))
    fresh = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"),
                                                date("l_shipdate").alias("day"))
    return sync_op(stored, fresh, "day", "1997-01-01", "1997-12-31")


@query("""
    SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) NOT BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'
    UNION ALL
    SELECT DISTINCT l_orderkey, l_linestatus, CAST(l_shipdate AS DATE) FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31'""")
def sync_stored(spark, sf):
    """A month of a stored table, in parts by month, replaced by another source; twice, as after a failure. Other parts' files stay."""
    stored = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", date("o_orderdate").alias("day"))
    fresh = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"),
                                                date("l_shipdate").alias("day"))
    month = F.date_format("day", "yyyy-MM").alias("month")
    root = scratch_path(spark, "synced")
    publish_once({"all": {"calendar": stored.select("*", month)}}, root, "first", parted={"calendar": "month"})
    for _ in range(2):
        sync_stored_window(root, "calendar", fresh.select("*", month), "month", "1997-03", "1997-03", "sync")
    return read_published(spark, root, "calendar", stored.schema)


@query("""
    WITH days AS (SELECT c_custkey, DATE '1997-06-15' + CAST(c_custkey % 30 AS INTEGER) AS day, CAST(c_custkey % 5 + 1 AS VARCHAR) AS team FROM customer),
    spells AS (SELECT o_custkey, left(o_orderpriority, 1) AS team, CAST(o_orderdate AS DATE) AS first_day,
                      CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) END AS last_day FROM orders),
    last AS (SELECT c_custkey, max({'f': first_day, 't': spells.team, 'e': last_day}) AS s FROM days JOIN spells ON o_custkey = c_custkey AND first_day <= day GROUP BY c_custkey),
    found AS (SELECT days.*, s.t AS before, CASE WHEN s IS NULL THEN 'new' WHEN s.e < day THEN 'return' WHEN s.t = team THEN 'same' ELSE 'change' END AS decision
              FROM days LEFT JOIN last USING (c_custkey))
    SELECT c_custkey, day, team, decision, before, CASE WHEN decision = 'change' THEN day - 1 END AS close_on,
           CASE WHEN decision IN ('change', 'return') THEN 'guaranteed' END AS kind FROM found""")
def contract_decisions(spark, sf):
    """Orders as contracts of customers, some ended; a day per customer says new, same, change or return."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    first_day = date("o_orderdate")
    spells = orders.select(F.col("o_custkey").alias("c_custkey"), first_day.alias("first_day"), F.substring("o_orderpriority", 1, 1).alias("team"),
                           F.when(F.col("o_orderkey") % 3 != 0, F.date_add(first_day, (F.col("o_orderkey") % 400).cast("int"))).alias("last_day"))
    days = customer.select("c_custkey", F.date_add(F.to_date(F.lit("1997-06-15")), (F.col("c_custkey") % 30).cast("int")).alias("day"),
                           (F.col("c_custkey") % 5 + 1).cast("string").alias("team"))
    return decide(spells, days, "c_custkey", "team", "day", "first_day", "last_day")


@query("""
    SELECT event_type, CAST(ts AS DATE) AS day, concat_ws(',', CASE WHEN grouping(event_type) = 0 THEN 'event_type' END, CASE WHEN grouping(CAST(ts AS DATE)) = 0 THEN 'day' END) AS sets,
           count(*) AS n, count(value) AS n_cents, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS sum_cents, min(CAST(round(value * 100) AS BIGINT)) AS min_cents,
           max(CAST(round(value * 100) AS BIGINT)) AS max_cents FROM events
    GROUP BY GROUPING SETS ((event_type, CAST(ts AS DATE)), (event_type), (CAST(ts AS DATE)), ())""")
def rollup_batches(spark, sf):
    """Statistics stored batch by batch, some folded, one batch stored twice, and read at four groupings."""
    events = table(spark, sf, "events").select("event_id", "event_type", date("ts").alias("day"), "user_id", F.round(F.col("value") * 100).cast("long").alias("cents"))
    root = scratch_path(spark, "rollup")
    for k, batch in enumerate(_shuffled(events)):
        parts = partial_stats(batch, ["event_type", "day"], ["cents"], ["user_id"])
        for _ in range(2 if k == 1 else 1):
            store_parts(parts, root, k)
        fold_parts(spark, root, parts.schema, k, every=2)
    read = grouping_sets(read_parts(spark, root, parts.schema), [["event_type", "day"], ["event_type"], ["day"], []])
    return finished(read, ["cents"], ["user_id"]).select("event_type", "day", "sets", "n", "n_cents", "sum_cents", "min_cents", "max_cents")


@query("""
    SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) > 0 AS seen FROM events GROUP BY ALL""")
def dedup_stream(spark, sf):
    """Repeated games of a stream, in several batches: each counts once while the watermark lasts."""
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    root = scratch_path(spark, "dedup")
    for part in _shuffled(events):
        part.coalesce(1).write.mode("append").parquet(f"{root}/incoming")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/incoming")
    games = stream.select("user_id", "event_type", date("ts").alias("day"), date("ts").cast("timestamp").alias("at"))
    once = dedup_op(games, ["user_id", "event_type", "day"], "at", "366 days")
    once.writeStream.option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/games").format("parquet").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(once.schema).parquet(f"{root}/games").select("user_id", "event_type", "day", F.lit(True).alias("seen"))
