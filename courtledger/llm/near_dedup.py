"""Near duplicates by MinHash bands, odd sketches and full sets.

A text's set is its distinct word shingles. Texts with equal sets form a class and are linked by that; from then on a class
is one vertex. Each vertex has `BANDS` x `ROWS` MinHash samples: the bands propose pairs, and all samples, folded into a
bitmap by parity (an odd sketch, Mitzenmacher, Pagh and Pham 2014), estimate the similarity of a proposed pair from the
population count of an XOR. A second bitmap of the same kind holds the parities of the whole set: its XOR estimates how many
shingles two sets differ in, which is sharp for all but very long texts. Estimates only drop pairs that are below the
threshold by more than six standard deviations; the others are confirmed on full sets, made anew from the texts, so that no
link rests on a sketch.

A band bucket of k vertices is never expanded into k*k pairs. First each vertex is compared with one vertex, the least of
the leaders of its buckets; then with those of its buckets' leaders that are still in another component; then, while many pairs of buckets are
left, with a few leaders drawn by a hash; then vertices of the same bucket that are still in different components are compared with each other, in blocks of bounded size, and a pair leaves the comparison
only if its sketches are close. After each round, links are between components found so far, not between vertices. So a
group of copies costs about as many pairs as it has members, and no link between components is lost.

A pair at the threshold itself shares no band with a probability of (1 - 0.8^5)^30, 7 in a million.

Defined cases: a null or empty text, or one of white space, has an empty set and is linked with nothing; a text of fewer
words than a shingle has its whole sequence as its one shingle; equal ids are one vertex; rows with a null id are kept
and are in no component; an empty table gives an empty table; columns other than id and text are ignored.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..operators.skew import own_shuffle
from ..session import cut_lineage
from .common import id_and_text, likely_rows, map_batches, registry, rows_without, table
from .pretokens import of_worker

QUERIES, SQL, query = registry()

BANDS, ROWS, BITS = 30, 5, 512
#: Bits of the bitmap of a whole set.
SET_BITS = 2048
SAMPLES = BANDS * ROWS
#: Pairs whose sketches estimate less than this are dropped; six standard deviations of the estimate below 0.8.
LEAST_ESTIMATE = 0.55
#: Vertices of a bucket that are compared with each other at once.
BLOCK = 1024
#: Rounds of drawn leaders at most, leaders that a vertex meets in one, and pairs to a row that need no round.
ROUNDS, DRAWN, EASY = 4, 3, 4
#: Words whose hash a worker remembers.
CACHE = 400_000
#: Tasks over which the nodes of one component are dealt.
DEALT = 32
_rng = np.random.default_rng(20)
FACTORS = (_rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
SHIFTS = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)[:, None]
SALTS = _rng.integers(0, 1 << 63, SAMPLES, dtype=np.uint64)
MULTIPLIERS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
KINDS = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], dtype=np.uint64)


def mix(h):
    """A 64-bit finaliser over an array."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class WordHashes(dict):
    def __missing__(self, word):
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str, n_words: int):
    """The set of a text as sorted 64-bit hashes: A-Z lower-cased, words between white space, n words each."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    # Of the worker, so that they go when it turns to another stage.
    known = of_worker("word hashes", WordHashes)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(n_words, len(words))
    n = len(words) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += hashes[k:k + n] * MULTIPLIERS[k]
    return np.unique(mix(total))


def samples(found):
    """MinHash samples of a non-empty set; long sets in parts, so memory has a bound."""
    low = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    short = (found >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        np.minimum(low, (FACTORS * short[None, at:at + 4096] + SHIFTS).min(axis=1), out=low)
    return low


def band_keys(low):
    rows = low.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, r])
    return key.astype(np.int64)


def odd_sketch(low):
    """Each sample toggles a bit: equal samples of two sets cancel out in the XOR of their sketches."""
    at = (mix(low.astype(np.uint64) + SALTS) >> np.uint64(13)).astype(np.int64) % BITS
    bits = (np.bincount(at, minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def set_parities(found):
    """Each shingle toggles a bit; what is left of the XOR of two sets comes from the shingles they do not share."""
    at = ((found >> np.uint64(9)) % np.uint64(SET_BITS)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=SET_BITS) & 1).astype(np.uint8)).view(np.int64)


def most_different_bits(least=LEAST_ESTIMATE) -> int:
    """The population count at which two sketches estimate a similarity of `least`."""
    return int((1 - np.exp(-4 * SAMPLES * (1 - least) / BITS)) * BITS / 2)


def _lists(arrays):
    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]).astype(np.int64)))


def sketches(df: DataFrame, n_words: int, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row: the size of the set, two hashes of the whole set, its band keys, odd sketch and parities."""
    none = np.zeros(0, np.int64)

    def step(batch):
        sizes, wholes, bands, odd, parities = [], ([], []), [], [], []
        for text in batch.column("text").to_pylist():
            found = shingles(text, n_words)
            low = samples(found) if len(found) else None
            sizes.append(len(found))
            for kind, whole in zip(KINDS, wholes):
                whole.append(int(mix(found ^ kind).sum(dtype=np.uint64).astype(np.int64)) if len(found) else 0)
            bands.append(band_keys(low) if low is not None else none)
            odd.append(odd_sketch(low) if low is not None else none)
            parities.append(set_parities(found) if low is not None else none)
        return {"doc_id": batch.column("doc_id"), "n_shingles": sizes, "set_a": wholes[0], "set_b": wholes[1], "bands": _lists(bands), "sketch": _lists(odd),
                "parities": _lists(parities)}
    return map_batches(id_and_text(df, id_col, text_col), step,
                       "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch array<long>, parities array<long>")


def different_bits(a, b, n_bits):
    total = F.bit_count(a[0].bitwiseXOR(b[0]))
    for i in range(1, n_bits // 64):
        total = total + F.bit_count(a[i].bitwiseXOR(b[i]))
    return total


def may_be_linked(a, b, percent):
    """Whether two vertices (functions from a column's name to the column) can have `percent` of their union in common."""
    sizes = (a("n_shingles"), b("n_shingles"))
    # The most shingles that sets of these sizes may differ in, and the bits that so many toggle: mean and deviation.
    most = F.floor((sizes[0] + sizes[1]) * ((100 - percent) / (100 + percent)))
    mean = SET_BITS / 2 * (1 - F.exp(-2 * most / SET_BITS))
    variance = SET_BITS / 4 * (1 - F.exp(-4 * most / SET_BITS)) - most * F.exp(-4 * most / SET_BITS)
    bits = F.least(most.cast("double"), mean + 6 * F.sqrt(F.greatest(variance, F.lit(0.0))) + 4)
    return ((F.least(*sizes) * 100 >= F.greatest(*sizes) * percent)
            & (different_bits(a("sketch"), b("sketch"), BITS) <= most_different_bits(LEAST_ESTIMATE * percent / 80))
            & (different_bits(a("parities"), b("parities"), SET_BITS) <= bits))


def confirmed(pairs: DataFrame, texts: DataFrame, n_words: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have at least `percent` of their union in common. `texts` has doc_id and text."""
    wanted = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    rows = likely_rows(texts, wanted).join(own_shuffle(wanted), "doc_id", "left_semi")

    def step(batch):
        return {"doc_id": batch.column("doc_id"), "found": _lists([shingles(t, n_words).view(np.int64) for t in batch.column("text").to_pylist()])}
    sets = cut_lineage(map_batches(rows, step, "doc_id long, found array<long>"))
    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("found").alias(f"found_{name}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("found_a", "found_b"))
    return both.where(shared * 100 >= (F.size("found_a") + F.size("found_b") - shared) * percent).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of the links (a, b): the smallest node that can be reached.

    Each round a node and its parent take the smallest parent among the node's neighbours, and parents their parents', so
    the number of rounds grows with the logarithm of the longest path. Rounds are written; only a count reaches the driver.
    """
    both = cut_lineage(links.select(F.col("a").alias("node"), F.col("b").alias("other"))
                       .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct())
    parents = cut_lineage(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("parent")))
    while True:
        of = parents.select(F.col("node").alias("other"), F.col("parent").alias("best"))
        near = own_shuffle(both.join(of, "other").groupBy("node").agg(F.min("best").alias("best")))
        hooked = parents.join(near, "node")
        jumped = parents.join(of.withColumnRenamed("other", "parent"), "parent").select("node", "best")
        new = (parents.select("node", F.col("parent").alias("best"), F.col("parent").alias("was"))
               .unionByName(hooked.select("node", "best"), allowMissingColumns=True)
               .unionByName(hooked.select(F.col("parent").alias("node"), "best"), allowMissingColumns=True)
               .unionByName(jumped, allowMissingColumns=True)
               .groupBy("node").agg(F.min("best").alias("parent"), F.min("was").alias("was")))
        new = cut_lineage(new)
        parents = new.select("node", "parent")
        if new.where("parent <> was").isEmpty():
            return parents.withColumnRenamed("parent", "component")


def merged(linked: DataFrame, links: DataFrame) -> DataFrame:
    """node, component for the same nodes after more links (a, b) between them: links are contracted to the components so far."""
    end = lambda name: linked.select(F.col("node").alias(name), F.col("component").alias(f"of_{name}"))
    half = links.join(end("b"), "b").select("a", "of_b").distinct()
    contracted = own_shuffle(half).join(end("a"), "a").where("of_a <> of_b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")).distinct()
    contracted = cut_lineage(contracted)
    if contracted.isEmpty():
        return linked
    # A component may have any number of nodes: they are dealt over DEALT tasks.
    better = components(contracted).select(F.col("node").alias("component"), F.col("component").alias("better"), F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))).alias("salt"))
    salted = linked.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(DEALT)).cast("int"))
    return cut_lineage(salted.join(own_shuffle(better), ["component", "salt"], "left").select("node", F.coalesce("better", "component").alias("component")))


def leader_links(buckets: DataFrame, vertices: DataFrame, confirm) -> DataFrame:
    """node, component of all vertices after they were compared with the leaders of their buckets. `confirm` gives the links among pairs."""
    linked = cut_lineage(vertices.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component")).distinct())
    # At most BANDS leaders to a vertex.
    leaders = cut_lineage(buckets.where("node <> leader").groupBy("node").agg(F.collect_set("leader").alias("leaders")))
    linked = merged(linked, confirm(cut_lineage(leaders.select(F.array_min("leaders").alias("a"), F.col("node").alias("b")))))
    rest = cut_lineage(leaders.where("size(leaders) > 1").join(linked, "node"))
    pairs = rest.select(F.col("node").alias("b"), "component", F.explode("leaders").alias("a"))
    # Only leaders that have followers in other components are looked at again.
    spans = own_shuffle(pairs.groupBy("a").agg(F.min("component").alias("low"), F.max("component").alias("high")))
    own = linked.select(F.col("node").alias("a"), F.col("component").alias("own"))
    still_open = cut_lineage(spans.join(own, "a").where("low <> own OR high <> own").select("a", "own"))
    second = cut_lineage(pairs.join(own_shuffle(still_open), "a").where("component <> own").select("a", "b"))
    return linked if second.isEmpty() else merged(linked, confirm(second))


def bucketed(vertices: DataFrame) -> DataFrame:
    """node, band, leader, n: the buckets of two or more vertices; the leader is the smallest of them."""
    rows = vertices.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    leaders = rows.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(own_shuffle(leaders), "band")


SKETCHES = ("n_shingles", "sketch", "parities")


def with_sketches(pairs: DataFrame, vertices: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches do not rule a link out."""
    side = lambda name: vertices.select(F.col("doc_id").alias(name), F.struct(*SKETCHES).alias(f"of_{name}"))
    of = lambda name: lambda column: F.col(f"of_{name}.{column}")
    return pairs.join(side("a"), "a").join(side("b"), "b").where(may_be_linked(of("a"), of("b"), percent)).select("a", "b")


def open_buckets(buckets: DataFrame, linked: DataFrame):
    """band, node, leader, component, n of buckets whose vertices are in different components (stored); and of these buckets the rows, the
    pairs of vertices in different components, and the components, each summed up."""
    # In a bucket of two, the one pair has been compared with its leader.
    rows = buckets.where("n > 2").drop("n").join(own_shuffle(linked), "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = cut_lineage(rows)
    sizes = rows.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size")).groupBy("band").agg(
        F.sum("size").alias("n"), F.sum(F.col("size").cast("double") * F.col("size")).alias("within"), F.count(F.lit(1)).alias("components"))
    still_open = cut_lineage(sizes.where("components > 1"))
    sums = still_open.agg(F.sum("n"), F.sum((F.col("n").cast("double") * F.col("n") - F.col("within")) / 2), F.sum("components")).first()
    return cut_lineage(rows.join(own_shuffle(still_open.select("band", "n")), "band")), *[x or 0 for x in sums]


def drawn_leader_links(buckets: DataFrame, linked: DataFrame, confirm):
    """node, component after comparisons with leaders drawn by a hash, and the buckets that are still open.

    The smallest vertex leads nearly all buckets of a large group; a drawn one differs from band to band and from round to round. Each vertex
    meets `DRAWN` of its buckets' leaders in a round, so a round's pairs grow with the vertices. There are rounds for as long as the pairs in
    different components far outnumber the rows and a round merges components; what is left is for `open_pairs`.
    """
    rows, n_rows, n_pairs, n_components = open_buckets(buckets, linked)
    for turn in range(ROUNDS):
        if n_pairs <= EASY * n_rows:
            break
        heads = rows.groupBy("band").agg(F.min_by(F.struct("node", "component"), F.xxhash64("node", "band", F.lit(turn))).alias("head"))
        met = rows.join(own_shuffle(heads), "band").where("component <> head.component").select("node", F.col("head.node").alias("head"))
        # At most BANDS leaders to a vertex.
        drawn = met.groupBy("node").agg(F.collect_set(F.struct(F.xxhash64("head", "node", F.lit(turn)).alias("by"), "head")).alias("heads"))
        pairs = drawn.select("node", F.explode(F.slice(F.array_sort("heads"), 1, DRAWN)["head"]).alias("head"))
        more = merged(linked, confirm(cut_lineage(pairs.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct())))
        if more is linked:
            break
        linked, before = more, n_components
        rows, n_rows, n_pairs, n_components = open_buckets(buckets, linked)
        if n_components > 0.9 * before:
            break
    return linked, rows


def open_pairs(buckets: DataFrame, linked: DataFrame, vertices: DataFrame, percent: int, rows: DataFrame | None = None) -> DataFrame:
    """Pairs of a bucket that are in different components and were not compared with its leader, if their sketches do not rule a link out.
    `rows` are the open buckets, if they are at hand."""
    rows = (open_buckets(buckets, linked)[0] if rows is None else rows).where("node <> leader")
    rows = rows.join(vertices.select(F.col("doc_id").alias("node"), F.struct(*SKETCHES).alias("of")), "node")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    # A block meets each block once: as the first of the pair with later ones, as the second with earlier ones and itself.
    first = rows.select("band", "node", "component", "of", own.alias("x"), F.explode(F.sequence(own, blocks - 1)).alias("y"))
    second = rows.select("band", "node", "component", "of", F.explode(F.sequence(F.lit(0), own)).alias("x"), own.alias("y"))
    a, b = first.alias("l"), second.alias("r")
    keys = (F.col("l.band") == F.col("r.band")) & (F.col("l.x") == F.col("r.x")) & (F.col("l.y") == F.col("r.y"))
    differ = (F.col("l.component") != F.col("r.component")) & ((F.col("l.x") != F.col("l.y")) | (F.col("l.node") < F.col("r.node")))
    met = a.join(b, keys & differ & may_be_linked(lambda c: F.col(f"l.of.{c}"), lambda c: F.col(f"r.of.{c}"), percent))
    return met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()


def near_groups(df: DataFrame, n_words=5, percent=80, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id (the smallest id that links reach), kept (whether it is its own)."""
    texts = id_and_text(df, id_col, text_col)
    rows = cut_lineage(sketches(df, n_words, id_col, text_col))
    sets = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["set_a", "set_b", "n_shingles"]
    classes = sets.groupBy(*key).agg(F.min("doc_id").alias("class_id"))
    members = cut_lineage(sets.select("doc_id", *key).join(own_shuffle(classes), key).select("doc_id", "class_id").distinct())
    # An id that stands for its class; with equal ids of different texts, the smallest class of an id counts.
    heads = members.groupBy("class_id").agg(F.count(F.lit(1)).alias("size")).select(F.col("class_id").alias("doc_id"))
    vertices = cut_lineage(sets.select("doc_id", "bands", *SKETCHES).join(own_shuffle(heads), "doc_id", "left_semi").dropDuplicates(["doc_id", "bands"]))
    buckets = cut_lineage(bucketed(vertices))
    confirm = lambda pairs: cut_lineage(confirmed(cut_lineage(with_sketches(pairs, vertices, percent)), texts, n_words, percent))
    linked = leader_links(buckets, vertices, confirm)
    linked, still_open = drawn_leader_links(buckets, linked, confirm)
    others = cut_lineage(open_pairs(buckets, linked, vertices, percent, still_open))
    if not others.isEmpty():
        linked = merged(linked, cut_lineage(confirmed(others, texts, n_words, percent)))
    # Ids that several classes share tie those together.
    linked = merged(linked, members.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).where("a <> b").select("a", "b"))
    named = members.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    named = named.join(own_shuffle(linked.withColumnRenamed("node", "class_id")), "class_id", "left")
    named = named.select("doc_id", F.coalesce("component", "class_id").alias("component_id"))
    out = rows.select("doc_id", "n_shingles").join(own_shuffle(named), "doc_id", "left")
    own = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, n_words=5, percent=80, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of documents that are their component's smallest id, with all their columns; rows with a null id stay.

    Texts are not shuffled, but for rows that go.
    """
    gone = cut_lineage(near_groups(docs, n_words, percent, id_col, text_col).where("NOT kept").select("doc_id").distinct())
    return rows_without(docs, gone, id_col)


@query()
def op5_near_duplicates(spark, sf_dir):
    """Components of near-equal documents, on four-word shingles."""
    return near_groups(table(spark, sf_dir, "documents"), 4, 80)
