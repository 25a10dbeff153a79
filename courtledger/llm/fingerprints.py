"""Fingerprints as Merkle trees over paragraphs and sections, in DataFrame functions only.

Lines are paragraphs. The leaves are runs of words, cut by content: a run ends behind a word whose own hash says so (one
in four), so that a word put in or taken out changes the runs around it only. A paragraph's node is the SHA-256 of its
leaves' SHA-256; a section is a run of paragraphs, ended where a paragraph's own hash says so (one in four) or by a blank
line, so that an insertion changes the sections around it only; a section's node hashes its paragraphs' nodes, and the
root hashes the sections' nodes. Equal roots mean equal texts, and sections that differ tell where an edit is. Two
fingerprints are compared by the first 24 bits of their leaves: their likeness is the share of different leaves that both
have (Dice), and 1 for equal roots.

The next document in descending order of the id is found without a global sort: ids are cut into ranges of about `ROWS`
documents by their percentiles, a window finds the neighbour within a range, and the last document of each range takes the
first of the range below; there are at most `RANGES` ranges, so that step is small whatever the table holds.

Defined cases: a null or empty text is one empty paragraph without runs; equal ids stand in descending order of their
texts; null ids come last; a single document is its own next one; an empty table gives an empty table; columns other than
id and text are ignored, whatever their names.
"""

from math import ceil, isqrt

from pyspark.sql import DataFrame, Window, functions as F

from ..operators.skew import own_shuffle
from .common import id_and_text, registry, table

QUERIES, SQL, query = registry()

ROWS, RANGES = 1024, 65_536
#: A word with the space after it, or space at the start of a line. Of a word of over 40 characters (a line without spaces, too)
#: each character counts as a word, but for its last 40: so runs find their way again within such words as well.
WORD = r"\S{1,40}+(?!\S)\s*+|\S|\s++"
#: One paragraph in so many ends a section, one word a run; one character of a long word in so many.
SECTION, RUN, RUN_CHARS = 4, 4, 8


def leaves(paragraph):
    """The hashes of a paragraph's runs; the runs in their order are the whole paragraph. It holds no line end: that marks the cuts."""
    ends = lambda w: F.pmod(F.xxhash64(w), F.when(F.length(w) == 1, RUN_CHARS).otherwise(RUN)) == 0
    words = F.regexp_extract_all(paragraph, F.lit(WORD), F.lit(0))
    marked = F.array_join(F.transform(words, lambda w: F.when(ends(w), F.concat(w, F.lit("\n"))).otherwise(w)), "")
    return F.transform(F.array_remove(F.split(marked, "\n"), ""), lambda run: F.sha2(run, 256))


def tree(text, leaf_name):
    """The struct of a text's fingerprint, from the leaves of its paragraphs: nodes of paragraphs, and short hashes of runs."""
    short = lambda leaf: F.conv(F.substring(leaf, 1, 6), 16, 10).cast("long")
    return F.struct(F.transform(leaf_name, lambda nodes: F.sha2(F.array_join(nodes, ""), 256)).alias("paragraphs"),
                    F.array_distinct(F.transform(F.flatten(leaf_name), short)).alias("runs"),
                    F.transform(F.split(text, "\n", -1), lambda p: F.length(F.trim(p)) == 0).alias("blank"))


def with_fingerprint(df: DataFrame, text_name: str, name: str) -> DataFrame:
    """Adds `name` (the fingerprint as text), `name`_root, `name`_sections and `name`_runs."""
    t = f"{name}_tree"
    ends = F.filter(F.sequence(F.lit(1), F.size(f"{t}.paragraphs")), lambda i: (i == F.size(f"{t}.paragraphs"))
                    | F.col(f"{t}.blank")[i - 1] | (F.conv(F.substring(F.col(f"{t}.paragraphs")[i - 1], 1, 4), 16, 10).cast("int") % SECTION == 0))
    sections = F.transform(f"{name}_ends", lambda end, k: F.sha2(F.array_join(F.slice(
        f"{t}.paragraphs", F.when(k == 0, 1).otherwise(F.element_at(f"{name}_ends", F.greatest(k, F.lit(1)))
                                                       + 1), end - F.when(k == 0, 0).otherwise(F.element_at(f"{name}_ends", F.greatest(k, F.lit(1))))), ""), 256))
    df = df.withColumn(f"{name}_leaves", F.transform(F.split(text_name, "\n", -1), leaves)).withColumn(t, tree(F.col(text_name), f"{name}_leaves"))
    df = df.withColumn(f"{name}_ends", ends).withColumn(f"{name}_sections", sections)
    df = df.withColumn(f"{name}_root", F.sha2(F.array_join(f"{name}_sections", ""), 256)).withColumn(f"{name}_runs", F.col(f"{t}.runs"))
    short = F.array_join(F.transform(f"{name}_sections", lambda s: F.substring(s, 1, 8)), ",")
    runs = F.array_join(F.transform(f"{name}_runs", lambda r: F.lpad(F.lower(F.hex(r)), 6, "0")), "")
    return df.withColumn(name, F.concat_ws(":", f"{name}_root", short, runs)).drop(t, f"{name}_leaves", f"{name}_ends")


def likeness(a: str, b: str):
    """0 to 1: twice the runs that both fingerprints have over the runs of either, each run of a text once; 1 for equal roots."""
    runs_a, runs_b = F.col(f"{a}_runs"), F.col(f"{b}_runs")
    total = F.size(runs_a) + F.size(runs_b)
    shared = F.size(F.array_intersect(runs_a, runs_b))
    return F.when(F.col(f"{a}_root") == F.col(f"{b}_root"), 1.0).when(total == 0, 0.0).otherwise(2.0 * shared / total)


def differing_sections(a: str, b: str):
    """Indexes of the sections of `a` that `b` does not have: where to look for edits."""
    return F.filter(F.transform(f"{a}_sections", lambda s, k: F.when(~F.array_contains(F.col(f"{b}_sections"), s), k)), lambda k: k.isNotNull())


def fingerprints(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row: the id, the fingerprint as text, its root, sections and runs."""
    return with_fingerprint(id_and_text(df, id_col, text_col), "text", "fingerprint").drop("text")


def _range_of(rows: DataFrame, n_ranges: int):
    """The number of a row's id range, by percentiles: found among about sqrt(n) coarse bounds, then among as many fine ones."""
    probs = [i / n_ranges for i in range(1, n_ranges)]
    bounds = rows.agg(F.percentile_approx("doc_id", probs, max(10_000, 8 * n_ranges)).alias("b")).first()["b"] if probs else []
    bounds = sorted(set(bounds or []))
    if not bounds:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    width = max(1, isqrt(len(bounds)))
    parts = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    longs = lambda values: F.array(*map(F.lit, values)).cast("array<bigint>")
    coarse, fine = longs([p[0] for p in parts]), F.array(*map(longs, parts))
    of_id = lambda bound: bound <= F.col("doc_id")
    n = F.size(F.filter(coarse, of_id))
    within = F.when(n == 0, 0).otherwise((n - 1) * width + F.size(F.filter(F.element_at(fine, F.greatest(n, F.lit(1))), of_id)))
    return F.when(F.col("doc_id").isNull(), -1).otherwise(within)


def with_next(rows: DataFrame) -> DataFrame:
    """doc_id, text and `next_text`, the text of the next document by descending id; the last one is followed by the first."""
    n_ranges = min(RANGES, max(1, ceil(rows.count() / ROWS)))
    ranged = rows.select("doc_id", "text", _range_of(rows, n_ranges).alias("range"))
    order = Window.partitionBy("range").orderBy(F.desc_nulls_last("doc_id"), F.desc("text"))
    placed = ranged.select("doc_id", "text", "range", F.lead("text").over(order).alias("next_text"), F.lag(F.lit(1)).over(order).alias("before"))
    inner = placed.where("next_text IS NOT NULL").select("doc_id", "text", "next_text")
    # One row per range from here on: at most RANGES rows.
    # (The first of a range is told by having none before it: a row number would be turned into a limit of its own below the
    # shuffle, and the texts would be shuffled once more.)
    first = placed.where("before IS NULL").select(F.col("range").alias("from_range"), F.col("text").alias("next_text"))
    all_ranges = Window.orderBy(F.desc("range"))
    whole = all_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    chain = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.lead("range").over(all_ranges), F.first("range").over(whole)).alias("from_range"))
    last = (placed.where("next_text IS NULL").select("doc_id", "text", "range").join(own_shuffle(chain), "range")
            .join(own_shuffle(first), "from_range").select("doc_id", "text", "next_text"))
    return inner.unionByName(last)


def edited(text, next_text):
    """The last third of a text replaced by as many code points of the next one, or all of them."""
    k = F.floor(F.char_length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - k), F.substring(next_text, F.lit(1), k))


@query()
def op9_merkle_fingerprints(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts, and how like they are to each other and to the next one."""
    rows = with_next(id_and_text(table(spark, sf_dir, "documents")))
    rows = rows.withColumn("edited_text", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited_sha256", F.sha2("edited_text", 256))
    for text, name in (("text", "fingerprint"), ("edited_text", "edited_fingerprint"), ("next_text", "next_fingerprint")):
        rows = with_fingerprint(rows, text, name).drop(text)
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       likeness("fingerprint", "edited_fingerprint").alias("near_edited"), likeness("fingerprint", "next_fingerprint").alias("near_next"))
