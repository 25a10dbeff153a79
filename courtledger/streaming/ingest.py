"""Micro-batch ingestion into stored tables.

Three kinds of tables: state that is written whole, of which only the newest version counts and which
should stay small (greatest ids); keyed state, of which a batch writes the rows that it changes (`keyed`); and logs,
which only grow, some in a folder per day, so that a batch reads the days it needs. What batch n writes is a function
of the tables before it and of batch n alone, and has folders of its own. A batch repeated after a failure
writes the same folders again, so nothing is doubled. The last thing written of a batch is its mark;
readers take what marked batches wrote, so they never see half of one. Versions of the state before the last
two are removed after the mark.

Days may arrive in any order: a batch with days before stored ones corrects the spells that they
cut, also closed ones, from the log of days seen.
"""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from courtledger import fixed_values as fv
from courtledger.operators.history import observed_days, scd2_apply, scd2_correct
from courtledger.operators.skew import own_shuffle
from courtledger.plans.day import GROUPS, ID_COLUMNS, conform, process_days, read_day_pages
from courtledger.schemas import LAST_IDS, LAST_SEEN, REJECTS, STORED
from courtledger.session import cut_lineage
from courtledger.sources.tables import COMMITS, commit_batch, last_commit, path_exists, prune, read_version, remove, version_path
from courtledger.streaming.keyed import Keyed, Parted, changes, fold, read_keyed, write_changes


#: Folder of the batch being worked on; readers of tables skip names that begin so.
INCOMING = "_incoming"


def log_path(root, name, batch_id):
    return f"{root}/{name}/batch={batch_id}"


def read_log(spark: SparkSession, root, name, schema, before=None, where=None) -> DataFrame:
    """Rows of the finished batches of a log, or of the batches before one. A condition on the column by which the log is
    parted chooses its folders."""
    if not path_exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], schema)
    fields = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    end = last_commit(spark, root) + 1 if before is None else before
    rows = spark.read.schema(fields).parquet(f"{root}/{name}").filter(F.col("batch") < end)
    return (rows if where is None else rows.filter(where)).select(*schema.fieldNames())


def _read(spark, root, name, kind, before, where=None):
    """A state table as of the batches before one; `kind` is its schema, or Keyed."""
    if isinstance(kind, Keyed):
        return read_keyed(spark, f"{root}/{name}", kind, before, where)
    rows = read_version(spark, f"{root}/{name}", before - 1, kind)
    return rows if where is None else rows.filter(where)


def run_batch(batch: DataFrame, batch_id: int, root, states: dict, step) -> None:
    """Carry one batch into the stored tables; running it again writes the same once more.

    step(batch, state, batch_id) gives all state tables anew, or the changed rows of keyed ones, and rows to add to any
    logs (as a frame, or `Parted`). A batch may hold several days in any order of arrival, so it has to use
    the bulk form of the spell operators.
    """
    spark = batch.sparkSession
    state = {name: _read(spark, root, name, kind, batch_id) for name, kind in states.items()}
    # Read once for all the tables written; stored, so that a lost executor does not read the source again.
    incoming = f"{root}/{INCOMING}/{batch_id}"
    batch.write.mode("overwrite").parquet(incoming)
    new_state, logs = step(spark.read.schema(batch.schema).parquet(incoming), state, batch_id)
    missing = set(states) - set(new_state)
    if missing:
        raise ValueError(f"no new version of {sorted(missing)}")
    for name, rows in logs.items():
        rows, by = rows if isinstance(rows, Parted) else (rows, None)
        writer = rows.repartition(by).write.partitionBy(by) if by else rows.write
        writer.mode("overwrite").parquet(log_path(root, name, batch_id))
    for name, df in new_state.items():
        if isinstance(states[name], Keyed):
            write_changes(df, f"{root}/{name}", states[name], batch_id)
        else:
            df.write.mode("overwrite").parquet(version_path(f"{root}/{name}", batch_id))
    commit_batch(spark, root, batch_id)
    for name, kind in states.items():
        if isinstance(kind, Keyed):
            fold(spark, f"{root}/{name}", kind, batch_id)
        else:
            prune(spark, f"{root}/{name}", "v=", batch_id - 1)
    prune(spark, f"{root}/{COMMITS}", "", batch_id - 1)
    remove(spark, incoming)


def ingest_stream(stream: DataFrame, root, states: dict, step, checkpoint, once=True):
    """`run_batch` on every micro-batch; states: {name: schema}, empty before the first.

    With once=True the query stops when all files now there are read. Returns the streaming query.
    """
    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, batch_id: run_batch(batch, batch_id, root, states, step)))
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_state(spark: SparkSession, root, states: dict) -> dict:
    """Every state table as of the newest finished batch."""
    version = last_commit(spark, root)
    return {name: _read(spark, root, name, kind, version + 1) for name, kind in states.items()}


def spell_step(key, attr, day, start, end, order=None, name="spells"):
    """A step that carries spells: open ones are the state, closed ones go to the log."""
    def step(batch, state, batch_id):
        change = scd2_apply(state[f"open_{name}"], batch, key, attr, day, start, end, order)
        after = change.all()
        return ({f"open_{name}": after.filter(F.col(end).isNull())},
                {f"closed_{name}": after.filter(F.col(end).isNotNull())})
    return step


def spell_state(schema: T.StructType, key, start, end, name="spells") -> dict:
    """The state of `any_order_step`: all spells, open and closed, by member and first day."""
    return {name: Keyed(schema, (key, start), sort=end)}


def any_order_step(root, key, attr, day, start, end, order=None, name="spells"):
    """A step that carries spells from days in any order of arrival. The days seen go to a log in a folder per day."""
    def step(batch, state, batch_id):
        days = cut_lineage(observed_days(batch, key, attr, day, order))
        log = f"{name}_days"
        first = days.agg(F.min(day).alias("d")).first()["d"]  # one row
        if first is None:
            return {name: state[name].limit(0)}, {log: Parted(days, day)}
        seen = read_log(batch.sparkSession, root, log, days.schema, batch_id, F.col(day) >= F.lit(first))
        reached = F.col(end).isNull() | (F.col(end) >= F.date_sub(F.lit(first), 1))
        change = scd2_correct(state[name].filter(reached), seen, days, key, attr, day, start, end, order, store=cut_lineage)
        return {name: changes(change.changed, change.gone.unionByName(change.moved), (key, start))}, {log: Parted(days, day)}
    return step


DAY_STATES = {"contrat": Keyed(STORED["contrat"], ("id_contrat",), sort="date_fin_contrat"),
              "blessure": Keyed(STORED["blessure"], ("id_blessure",), sort="date_guerison"),
              "last_ids": LAST_IDS, "last_seen": Keyed(LAST_SEEN, ("id_joueur",))}
DAY_LOGS = ["joueur", "match", "presence", "score_match", "stats_equipes", "stats_joueur"]
# Logs of which a batch reads only the days it needs.
_BY_DAY = {"match": "date_match", "presence": "date_match"}
_ENDS = {"contrat": "date_fin_contrat", "blessure": "date_guerison"}


def day_step(root, season=fv.DEFAULT_SEASON, game_type=fv.REGULAR_SEASON, injury_list=None, kinds=None):
    """A step that imports game pages, of days in any order. State: contracts and injuries, greatest ids and last game days. Logs:
    players, games, days seen, facts and rejects.

    injury_list(batch_id), if given, is the normalised list to apply after the batch, or None; kinds
    are the injury types. Of games and days seen only those of the batch's days, or later ones, are read, and
    of spells those that reach into them.
    """
    def step(pages, state, batch_id):
        spark = pages.sparkSession
        log = lambda name, where=None: read_log(spark, root, name, STORED[name], batch_id, where)
        span = pages.agg(F.min("game_date").cast("date").alias("a"), F.max("game_date").cast("date").alias("b")).first()  # one row
        first, last = (F.lit(span[c]).cast("date") for c in "ab")
        reached = lambda name: F.col(_ENDS[name]).isNull() | (F.col(_ENDS[name]) >= F.date_sub(first, 1))
        old = {name: cut_lineage(state[name].filter(reached(name))) for name in _ENDS}
        day = F.col("date_match")
        known = {"joueur": log("joueur"), "enum_type_blessure": kinds, "match": log("match", day.between(first, last)),
                 "presence": log("presence", day >= first), **old}
        # At most one row per table.
        last_ids = {r["name"]: r["last_id"] for r in state["last_ids"].collect()}
        outputs = process_days(
            read_day_pages(pages), known, season, game_type, last_ids={name: last_ids.get(name, 0) for name in ID_COLUMNS},
            injury_list=injury_list(batch_id) if injury_list else None, past_injuries=state["blessure"].filter("date_guerison IS NOT NULL"),
            groups=[g for g in (*GROUPS, "changes") if g not in ("contrat", "blesse")], last_seen=state["last_seen"])
        frames = {name: df for tables in outputs.values() for name, df in tables.items()}
        logs = {name: Parted(frames[name], _BY_DAY[name]) if name in _BY_DAY else frames[name] for name in [*DAY_LOGS, *REJECTS]}
        new_state = {name: changes(frames[f"{name}_changed"], frames[f"{name}_gone"], DAY_STATES[name].key) for name in _ENDS}
        given = [frames[n if n in DAY_LOGS else f"{n}_changed"].select(F.lit(n).alias("name"), F.col(c).alias("last_id")) for n, c in ID_COLUMNS.items()]
        new_state["last_ids"] = conform(reduce(DataFrame.unionByName, given, state["last_ids"]).groupBy("name")
                                        .agg(F.max("last_id").alias("last_id")), LAST_IDS)
        played = frames["stats_joueur"].select("id_joueur", "id_match").join(frames["match"].select("id_match", "date_match"), "id_match")
        played = played.groupBy("id_joueur").agg(F.max("date_match").alias("now"))
        new_state["last_seen"] = played.join(own_shuffle(state["last_seen"]), "id_joueur", "left").select("id_joueur", F.greatest("now", "date_match").alias("date_match"))
        return new_state, logs
    return step


def read_days(spark: SparkSession, root) -> dict:
    """The stored tables that `day_step` has built up."""
    state = read_state(spark, root, DAY_STATES)
    tables = {name: read_log(spark, root, name, STORED[name]) for name in DAY_LOGS}
    tables.update({name: read_log(spark, root, name, REJECTS[name]) for name in REJECTS})
    return {**{name: state[name] for name in _ENDS}, **tables}


def dedup_stream(stream: DataFrame, keys, event_time, delay) -> DataFrame:
    """Drop repeated games of a stream; keys are remembered until the watermark passes them."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))
