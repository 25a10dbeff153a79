"""Exact duplicates: a new batch against an immutable snapshot.

Texts are equal when their bytes are, after lower-casing A-Z. A batch is reduced to digests in one pass, and its own
duplicates are grouped by an aggregate that combines on the map side. A snapshot keeps one slim row per distinct text, in
buckets, with a static binary-fuse filter for each bucket. The batch's distinct digests are screened by the filter of
their bucket; only those it lets through are joined with the exact bucket, and the bytes of both texts are compared
before the two groups become one. Texts travel only for that check. The document with the largest id stays.

Defined cases: a null text counts as empty, so all empty texts are equal; a null id is smaller than any other; rows that
repeat an id and its text count as members of the group like any other row, and are all listed; an empty table gives an
empty table, an empty snapshot screens out nothing; columns other than id and text are ignored, whatever their names.
"""

import hashlib
from math import ceil
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import own_shuffle
from ..session import cut_lineage
from . import fuse
from .common import id_and_text, likely_rows, map_batches, registry, rows_without, table

QUERIES, SQL, query = registry()

#: Distinct texts per bucket of a snapshot, about.
BUCKET = 8192
KEY = ["text_sha256", "n_bytes"]


class Snapshot(NamedTuple):
    groups: DataFrame   # text_sha256, n_bytes, keep_id, group_size, bucket: one row per distinct text
    filters: DataFrame  # bucket, seed, segment, segments, slots
    texts: DataFrame    # doc_id, text: what the kept ids refer to
    n_buckets: int


def digests(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One slim row per row: id, SHA-256 and length of the normalised bytes."""
    def step(batch):
        raw = [t.lower() for t in batch.column("raw").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "text_sha256": [hashlib.sha256(t).hexdigest() for t in raw], "n_bytes": [len(t) for t in raw]}
    rows = id_and_text(df, id_col, text_col)
    return map_batches(rows.select("doc_id", F.col("text").cast("binary").alias("raw")), step, "doc_id long, text_sha256 string, n_bytes long")


def batch_groups(rows: DataFrame) -> DataFrame:
    """The duplicates within a batch: one row per distinct text."""
    return rows.groupBy(*KEY).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))


def _bucket(n):
    return F.pmod(F.xxhash64("text_sha256"), F.lit(n)).cast("long").alias("bucket")


def _keys(hex_digests):
    return np.array([int(d[:16], 16) for d in hex_digests], dtype=np.uint64)


def take_snapshot(rows: DataFrame, texts: DataFrame, n_buckets: int) -> Snapshot:
    """Freeze a batch of digests: its groups, dealt into buckets, and a filter for each bucket."""
    groups = cut_lineage(batch_groups(rows).select("*", _bucket(n_buckets)))

    def filter_of(part: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, slots = fuse.build(_keys(part["text_sha256"]))
        return pd.DataFrame({"bucket": part["bucket"].iloc[:1], "seed": seed, "segment": segment, "segments": segments, "slots": [slots]})
    filters = groups.select("bucket", "text_sha256").groupBy("bucket").applyInPandas(
        filter_of, "bucket long, seed long, segment long, segments long, slots binary")
    return Snapshot(groups, cut_lineage(filters), texts, n_buckets)


def screen(groups: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The groups of a batch with `maybe_seen`: false means that the snapshot certainly does not have the text."""
    schema = "text_sha256 string, n_bytes long, keep_id long, group_size long, maybe_seen boolean"

    def ask(part: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(len(part), bool)
        if len(filters) and len(part):
            f = filters.iloc[0]
            seen = fuse.maybe(_keys(part["text_sha256"]), f["seed"], f["segment"], f["segments"], f["slots"])
        return part.drop(columns="bucket").assign(maybe_seen=seen)
    dealt = groups.select(*KEY, "keep_id", "group_size", _bucket(snapshot.n_buckets))
    return dealt.groupBy("bucket").cogroup(snapshot.filters.groupBy("bucket")).applyInPandas(ask, schema)


def normalised(text):
    """A-Z lower-cased in a column, other letters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def confirm(screened: DataFrame, snapshot: Snapshot, texts: DataFrame) -> DataFrame:
    """Positives of the screen that the exact bucket has too, byte for byte: digest key, kept id and size on the snapshot's side."""
    known = snapshot.groups.select(*KEY, F.col("keep_id").alias("seen_id"), F.col("group_size").alias("seen_size"))
    pairs = screened.where("maybe_seen").join(known, KEY).select(*KEY, "keep_id", "seen_id", "seen_size")
    pairs = cut_lineage(pairs)
    new = _with_digest(texts, pairs, "keep_id", "new_text")
    old = _with_digest(snapshot.texts, pairs, "seen_id", "old_text", "seen_size")
    same = new.join(old, KEY).where(normalised(F.col("new_text")) == normalised(F.col("old_text")))
    return same.groupBy(*KEY).agg(F.max("seen_id").alias("seen_id"), F.max("seen_size").alias("seen_size"))


def _with_digest(texts: DataFrame, pairs: DataFrame, id_name, text_name, *more) -> DataFrame:
    """One text for each digest of the pairs, of the row that its id names. Repeated ids may carry several texts, and null ids, too, are ids
    here: the digest is part of the key, which also spreads them."""
    rows = texts.select(F.col("doc_id").alias("_id"), F.col("text").alias(text_name))
    digest = F.sha2(normalised(F.col(text_name)).cast("binary"), 256)
    rows = likely_rows(rows, pairs.select(id_name), "_id").withColumn("_digest", digest)
    wanted = own_shuffle(pairs.select(id_name, *more, *KEY))
    found = rows.join(wanted, (F.col("_digest") == F.col("text_sha256")) & F.col("_id").eqNullSafe(F.col(id_name)))
    return found.select(text_name, id_name, *more, *KEY).dropDuplicates(KEY)


def dedup(incoming: DataFrame, snapshot_rows: DataFrame | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row of both frames: doc_id, keep_id, group_size, kept, text_sha256.

    `snapshot_rows` are the rows taken in before; without them all duplicates are those within the batch.
    """
    new_rows = cut_lineage(digests(incoming, id_col, text_col))
    groups = batch_groups(new_rows)
    if snapshot_rows is None:
        return _listed(new_rows, groups)
    old_rows = cut_lineage(digests(snapshot_rows, id_col, text_col))
    n_buckets = max(1, ceil(max(old_rows.count(), new_rows.count()) / BUCKET))
    snapshot = take_snapshot(old_rows, id_and_text(snapshot_rows, id_col, text_col), n_buckets)
    screened = cut_lineage(screen(groups, snapshot))
    seen = cut_lineage(confirm(screened, snapshot, id_and_text(incoming, id_col, text_col)))
    both = (snapshot.groups.select(*KEY, "keep_id", "group_size")
            .unionByName(screened.select(*KEY, "keep_id", "group_size").join(own_shuffle(seen.select(*KEY)), KEY, "left_semi"))
            .groupBy(*KEY).agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    fresh = screened.select(*KEY, "keep_id", "group_size").join(own_shuffle(seen.select(*KEY)), KEY, "left_anti")
    # A text of the batch with the digest of an older one but other bytes would be a group of its own.
    all_rows = old_rows.withColumn("own", F.lit(False)).unionByName(
        new_rows.join(own_shuffle(fresh.select(*KEY).withColumn("own", F.lit(True))), KEY, "left").withColumn("own", F.coalesce("own", F.lit(False))))
    return _listed(all_rows, both.withColumn("own", F.lit(False)).unionByName(fresh.withColumn("own", F.lit(True))))


def _listed(rows, groups):
    key = [c for c in (*KEY, "own") if c in groups.columns]
    found = rows.join(own_shuffle(groups), key)
    return found.select("doc_id", "keep_id", "group_size", F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"), "text_sha256")


def in_two_batches(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """`dedup` over one table, whose rows are taken in as a snapshot and a batch of about equal size."""
    second = F.pmod(F.xxhash64(docs[id_col].cast("long")), F.lit(2)) == 1
    return dedup(docs.where(second), docs.where(~second), id_col, text_col)


def drop_copies(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the largest id, of rows that repeat id and text one.

    Rows without an id stay, since nothing names them; an id stays with all its texts if one of them does. Texts are not
    shuffled, but for rows that go.
    """
    found = cut_lineage(in_two_batches(docs, id_col, text_col).where("doc_id IS NOT NULL").groupBy("doc_id", "text_sha256")
                        .agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n")))
    gone = cut_lineage(found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("NOT kept").select("doc_id"))
    repeated = cut_lineage(found.where("n > 1").select("doc_id").distinct())
    left = rows_without(docs, gone, id_col)
    if repeated.isEmpty():
        return left
    again = likely_rows(left, repeated, id_col)
    again = again.join(own_shuffle(repeated.withColumnRenamed("doc_id", "__id")), again[id_col].cast("long") == F.col("__id"), "left_semi")
    return rows_without(left, repeated, id_col).unionByName(again.dropDuplicates([id_col, text_col]))


@query("""
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
""")
def op2_exact_dedup(spark, sf_dir):
    """Exact duplicates among all documents."""
    return in_two_batches(table(spark, sf_dir, "documents"))
