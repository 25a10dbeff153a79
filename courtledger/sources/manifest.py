"""Tables whose contents a manifest names: several of them change at once, or not at all.

Rows are first written to folders of their own. Then one file is created that names, for each table and part, the folders
that hold it; readers go by the newest such file, so they see a publication whole or not at all. A publication has a token: a
token that the manifest knows is not published again, so a job may be repeated after any failure. A file is never
overwritten; if another writer was faster, the change is made again on what that one left. Replacing parts writes
and names the parts concerned only; the folders of other parts stay as they are.
"""

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from courtledger.sources.tables import chosen_groups, filesystem

FOLDER = "_manifest"
#: The one part of a table that is not parted.
WHOLE = ""
#: Manifests kept for readers that began before the newest.
KEPT = 3


class Manifest(NamedTuple):
    version: int
    tables: dict   # {table: {part: [folder, ...]}}
    tokens: list   # publications that are in it


def read_manifest(spark: SparkSession, root) -> Manifest:
    fs, p = filesystem(spark, f"{root}/{FOLDER}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    # (A file that is being created may be empty or cut: it is renamed to its number when it is whole.)
    version = max((int(n) for n in names if n.isdigit()), default=-1)
    if version < 0:
        return Manifest(-1, {}, [])
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{FOLDER}/{version}"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    found = json.loads(text)
    return Manifest(version, found["tables"], found["tokens"])


def _write_manifest(spark, root, manifest: Manifest, token) -> bool:
    """Whether this writer was the one to write this version."""
    fs, p = filesystem(spark, f"{root}/{FOLDER}/{manifest.version}")
    Path = spark._jvm.org.apache.hadoop.fs.Path
    draft = Path(f"{root}/{FOLDER}/.{token}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest._asdict()).encode()))
    out.close()
    if fs.exists(p) or not fs.rename(draft, p):
        fs.delete(draft, False)
        return False
    for status in fs.listStatus(Path(f"{root}/{FOLDER}")):
        name = status.getPath().getName()
        if name.isdigit() and int(name) <= manifest.version - KEPT:
            fs.delete(status.getPath(), False)
    return True


def change(spark: SparkSession, root, token, edit) -> bool:
    """Publish `edit(tables)`, the new tables made from the newest ones; False if the token was published before."""
    while True:
        now = read_manifest(spark, root)
        if token in now.tokens:
            return False
        tables = edit({name: dict(parts) for name, parts in now.tables.items()})
        if _write_manifest(spark, root, Manifest(now.version + 1, tables, [*now.tokens, token]), token):
            return True


def _stage(df: DataFrame, root, name, token, by=None) -> dict:
    """Write the rows; {part: folder}. A part's rows lie in a folder of their own, with all their columns."""
    folder = f"{name}/{token}"
    if by is None:
        df.write.mode("overwrite").parquet(f"{root}/{folder}")
        return {WHOLE: folder}
    part = F.coalesce(F.col(by).cast("string"), F.lit("null"))
    df.withColumn("_part", part).repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{root}/{folder}")
    fs, p = filesystem(df.sparkSession, f"{root}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return {n.removeprefix("_part="): f"{folder}/{n}" for n in names if n.startswith("_part=")}


def publish_once(outputs, root, token, groups="all", parted=None) -> bool:
    """Append the chosen groups of named frames (as `publish` takes them), all or none of them, once per token.

    parted: {table: column}; such a table has a part per value of the column, a date, say.
    """
    frames = {name: df for group in chosen_groups(outputs, groups) for name, df in outputs[group].items()}
    spark = next(iter(frames.values())).sparkSession if frames else None
    if spark is None or token in read_manifest(spark, root).tokens:
        return False
    staged = {name: _stage(df, root, name, token, (parted or {}).get(name)) for name, df in frames.items()}

    def edit(tables):
        for name, parts in staged.items():
            for part, folder in parts.items():
                tables.setdefault(name, {}).setdefault(part, [])
                tables[name][part] = [*tables[name][part], folder]
        return tables
    return change(spark, root, token, edit)


def replace_parts(fresh: DataFrame, root, name, by, first, last, token) -> bool:
    """The parts from `first` to `last` (as texts) hold the fresh rows of that range and no others; other parts stay as they are."""
    spark, inside = fresh.sparkSession, lambda part: first <= part <= last
    if token in read_manifest(spark, root).tokens:
        return False
    part = F.col(by).cast("string")
    staged = _stage(fresh.filter(part.between(F.lit(first), F.lit(last))).dropDuplicates(), root, name, token, by)

    def edit(tables):
        kept = {p: folders for p, folders in tables.get(name, {}).items() if not inside(p)}
        tables[name] = {**kept, **{p: [folder] for p, folder in staged.items()}}
        return tables
    return change(spark, root, token, edit)


def folders_of(spark: SparkSession, root, name, parts=None) -> list:
    """The folders that hold a table now, or those of its parts for which parts(part) is true."""
    found = read_manifest(spark, root).tables.get(name, {})
    return [f"{root}/{folder}" for part, folders in sorted(found.items()) for folder in folders if parts is None or parts(part)]


def read_published(spark: SparkSession, root, name, schema, parts=None) -> DataFrame:
    """The rows of a table as of the newest manifest; only the folders of the parts asked for are read."""
    folders = folders_of(spark, root, name, parts)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
