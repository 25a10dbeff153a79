"""Matching rows to known members: filters, exclusions, key look-ups."""

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from courtledger.functions.text import as_column
from courtledger.operators.skew import member_keys, own_shuffle


def active_or_injured(dnp="dnp", injured="blesse") -> Column:
    return ~as_column(dnp) | as_column(injured)


def _keys_of(known, on, unique, hot):
    keys = known.select(*on)
    if unique:
        return keys
    return member_keys(known, on) if hot else keys.distinct()


def keep_members(df: DataFrame, known: DataFrame, on, unique=False, hot=True) -> DataFrame:
    """Rows whose key is known.

    unique: the known side has few rows per key, as a dimension has, and need not be reduced first.
    hot=False: df has few rows per key, so no key of it needs splitting; saves shuffles of known.
    """
    return df.join(_keys_of(known, on, unique, hot), on, "left_semi")


def drop_members(df: DataFrame, known: DataFrame, on, unique=False, hot=True) -> DataFrame:
    """Rows whose key is not known; a row with a null key is kept. Options as for keep_members."""
    return df.join(_keys_of(known, on, unique, hot), on, "left_anti")


def mark_members(df: DataFrame, known: DataFrame, on, name, hot=True) -> DataFrame:
    """Every row, with whether its key is known: both halves of a split in one join."""
    marker = known.select(*on).distinct().withColumn("_known", F.lit(True))
    joined = df.join(own_shuffle(marker) if hot else marker, list(on), "left")
    return joined.select(*df.columns, F.coalesce("_known", F.lit(False)).alias(name))


def unknown_members(df: DataFrame, dim: DataFrame, on, columns, unique=False) -> DataFrame:
    """The rows without a member in the dimension, not made unique.

    unique: the dimension has few rows per key already; else it is reduced to its keys first.
    """
    return drop_members(df, dim, on, unique=unique).select(*columns)


def exclude_marginal(df: DataFrame, known: DataFrame, columns) -> DataFrame:
    """Drop a row if each of its columns holds a value known in that column, in whatever rows.

    columns maps columns of df to columns of known. Not the same as excluding known pairs: a row
    goes as soon as its date is known from one row and its id from another. All columns but the
    last are marked by left joins with distinct values; the last is an anti join limited to the
    marked rows.
    """
    *first, (last, known_last) = list(columns.items())
    out = df
    for i, (column, known_column) in enumerate(first):
        values = known.select(F.col(known_column).alias(column)).filter(F.col(column).isNotNull())
        values = own_shuffle(values.distinct().withColumn(f"_m{i}", F.lit(True)))
        out = out.join(values, column, "left")
    values = known.select(F.col(known_last).alias("_v"))
    values = own_shuffle(values.distinct())
    marked = reduce(Column.__and__, [F.col(f"_m{i}").isNotNull() for i in range(len(first))], F.lit(True))
    return (out.join(values, (out[last] == values["_v"]) & marked, "left_anti")
               .select(*df.columns))


def all_duplicates(df: DataFrame, keys) -> DataFrame:
    """Every row whose key occurs more than once; null keys count as equal.

    Keys are shuffled as 128 bits of hash, however long they are: rows are counted by hash, the repeated hashes are few, and
    only rows that have one of them are counted by their keys. A hash shared by chance costs work, never a wrong row.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    digest = F.md5(F.concat(*[F.concat(F.when(F.col(k).isNull(), "0").otherwise(F.concat(F.lit("1"), F.length(F.col(k).cast("string")).cast("string"))),
                                       F.lit(":"), F.coalesce(F.col(k).cast("string"), F.lit(""))) for k in keys]))
    hashed = df.withColumn("_h", digest)
    common = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_h")
    suspects = hashed.join(own_shuffle(common), "_h", "left_semi")
    repeated = (suspects.select("_h", *[F.col(k).alias(n) for k, n in zip(keys, names)]).groupBy("_h", *names)
                .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n").withColumnRenamed("_h", "_g"))
    same = [suspects[k].eqNullSafe(repeated[n]) for k, n in zip(keys, names)]
    # The hash alone is what both sides are shuffled by; the keys are compared where it agrees.
    return suspects.join(repeated, reduce(Column.__and__, same, suspects["_h"] == repeated["_g"]), "left_semi").select(*df.columns)


def resolve_key(df: DataFrame, dim: DataFrame, on, id_col) -> DataFrame:
    """Add the id of the member of that name; null if there is none.

    Homonyms in the dimension multiply rows.
    """
    return df.join(dim.select(*on, id_col), on, "left")


def update_from(target: DataFrame, source: DataFrame, key, columns, order) -> DataFrame:
    """Overwrite columns of the target rows the source has a row for.

    The source is first made unique on the key: the row with the greatest `order` wins.
    """
    values = source.groupBy(*key).agg(
        F.max_by(F.struct(*columns), F.struct(*[F.col(c) for c in order])).alias("_new"))
    joined = target.join(own_shuffle(values), list(key), "left")
    return joined.select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c) for c in target.columns])


def literal_map(mapping) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*mapping.items())])


def lookup(c, mapping) -> Column:
    """Value of a key in a small literal map; null if it is not there."""
    return F.try_element_at(literal_map(mapping), as_column(c))


def invert(mapping):
    """member -> group, from group -> members."""
    return {member: group for group, members in mapping.items() for member in members}


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The row with the greatest `order` of each key; the last columns of `order` break ties.

    An aggregate, so only one row per key and task is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_row"))
    return best.select(*[F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])
