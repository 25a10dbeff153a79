"""Collocations by SON partitioning: frequent phrases of a few words, scored by how much they hold together.

Rows are dealt by a hash into `SHARDS` shards. Each shard is mined completely, level by level (words, pairs, triples), at the
support lowered to its share of the language's words: a phrase with `support` occurrences over all shards has at least that
share of them in one of them. The union of what is locally frequent holds every frequent phrase, and a last pass counts all of
its phrases over all rows exactly. The support is a number of occurrences and does not grow with the corpus, so a shard has
to be a fixed part of the corpus, or its local support would fall to 1 and mining would prune nothing; a shard is therefore
mined by as many tasks as there are, each of which counts in numpy before anything is shuffled.

While shards are mined, a phrase is a 64-bit hash: a collision adds up the counts of two phrases, so it may add a candidate and
never loses one. Locally frequent words and pairs prune the next level through bitmaps of a fixed greatest size (`BITS`): where
they are full, more is counted, and nothing else changes. The last pass counts words by their bytes; hashes only find
equal words of a block there, and a second hash shows whether they are equal indeed.

Scores are whole numbers, worked out in decimals of 38 digits: exact for counts of up to 14 digits. What holds of a long phrase's parts is
joined from the counts, with the hot words among them dealt over `SALTS` tasks; the best of a language are found among the best of
`PARTS` parts, so neither a frequent word nor a large language ends up in one task.

Defined cases: a null or empty text has no words; a null language counts as `und`; repeated rows, equal and null ids count
as often as they occur; a piece shorter than a phrase has none; an empty table gives an empty table; columns other than id,
text and language are ignored, whatever their names. Ties are broken as the columns are listed, then by the phrase's
bytes. Long texts are read in blocks that end between pieces, so memory is bounded by a piece, not by a text.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.skew import own_shuffle
from ..session import cut_lineage
from .common import BITMAP, bounded_batches, registry, table

QUERIES, SQL, query = registry()

#: Shards, as many as the low bits of a key can tell apart; and the hash places of languages, each with thresholds of its own.
SHARD_BITS, SLOTS = 2, 1024
SHARDS = 1 << SHARD_BITS
#: Bits of a bitmap at most (32 MB), and for each key that it holds.
BITS, BITS_PER_KEY = 1 << 28, 48
#: Bytes of text worked on at once, occurrences that a task gathers before it adds them up, and words that it then knows.
BLOCK, GATHER, KNOWN = 1 << 20, 2_000_000, (1 << 20) - 8
SALTS, PARTS = 8, 64

# What a byte is: part of a word (0), white space within a piece (1), or the end of a piece (2).
CLASS = np.zeros(256, np.uint8)
CLASS[[0x20, 0x09]] = 1
CLASS[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
LOWER = bytes(range(256)).lower()
_rng = np.random.default_rng(11)
_odd = lambda n: _rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: For each of two hashes: a value per byte, and the factor between places with its inverse.
BYTES = [_odd(256) for _ in range(2)]
FACTORS = [int(f) for f in _odd(2)]
OF_SLOT, OF_PLACE = _odd(SLOTS), _odd(8)


class Powers:
    """Powers of a factor and of its inverse modulo 2**64, as many as the longest block so far needs."""

    def __init__(self, factor):
        self.steps = np.uint64(factor), np.uint64(pow(factor, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n):
        if len(self.up) < n:
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, s, np.uint64), dtype=np.uint64)]) for s in self.steps)
        return self.up[:n], self.down


POWERS = [Powers(f) for f in FACTORS]


def mix(h):
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Block:
    """The words of some texts: where they start and end, of which text they are, and whether the next one follows in the same piece."""

    def __init__(self, texts, owners):
        self.data = b"\n".join(texts).translate(LOWER)
        self.codes = np.frombuffer(self.data, np.uint8)
        kind = CLASS[self.codes]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], (kind == 0).view(np.int8), [0]])))
        self.start, self.end = edges[::2], edges[1::2]
        piece = np.cumsum(kind == 2, dtype=np.int32)[self.start] if len(self.start) else np.zeros(0, np.int32)
        self.follows = np.append(piece[1:] == piece[:-1], False)[:len(piece)]
        places = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
        self.owner = np.asarray(owners)[np.searchsorted(places, self.start, "right") - 1]

    def hashes(self, which=0):
        """A hash of each word's bytes: a polynomial over them, from differences of running sums."""
        up, down = POWERS[which].to(len(self.codes))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTES[which][self.codes] * up, dtype=np.uint64)])
        lengths = (self.end - self.start).astype(np.uint64)
        return mix((sums[self.end] - sums[self.start]) * down[self.start] + lengths)

    def word(self, i):
        return self.data[self.start[i]:self.end[i]]


def blocks(texts, size=None):
    """Blocks of about `size` bytes; a longer text is cut behind the end of a piece. The owner of a word is its text's place in `texts`."""
    size = size or BLOCK
    waiting, owners, n = [], [], 0
    for owner, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > size:
                mark = PIECE_END.search(text, at + size)
                end = mark.end() if mark else end
            waiting.append(text[at:end] if at or end < len(text) else text)
            owners.append(owner)
            n += end - at
            at = end
            if n >= size:
                yield Block(waiting, owners)
                waiting, owners, n = [], [], 0
    if waiting:
        yield Block(waiting, owners)


def phrase_keys(hashes, slots, k):
    """Keys of the phrases of k words that begin at each word (of the last k - 1 words, they mean nothing). The low bits are free for a shard."""
    n = max(0, len(hashes) - k + 1)
    total = OF_SLOT[slots[:n]] * np.uint64(2 * k + 1)
    for j in range(k):
        total = total + hashes[j:j + n] * OF_PLACE[j]
    return mix(total) & ~np.uint64(SHARDS - 1)


def in_bitmap(bits, places):
    places = places & np.uint64(8 * len(bits) - 1)
    return (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def phrases_of(block, hashes, slots, longest, has):
    """(k, first words of the phrases of k words that stay, their keys) for each k; `has(k, keys, first)` says which stay.

    A phrase is asked for only if both its parts of k - 1 words stay.
    """
    stays = None
    for k in range(1, longest + 1):
        keys = phrase_keys(hashes, slots, k)
        if k == 1:
            stays = np.ones(len(keys), bool)
        else:
            stays = stays[:-1] & stays[1:] & block.follows[k - 2:len(block.follows) - 1] if len(keys) else np.zeros(0, bool)
        first = np.flatnonzero(stays)
        keep = has(k, keys[first], first)
        stays = np.zeros(len(keys), bool)
        stays[first[keep]] = True
        yield k, first[keep], keys[first[keep]]


def prepared(df: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """The bytes of a text, its language, the language's place and the row's shard."""
    text, lang = F.coalesce(df[text_col].cast("string"), F.lit("")), F.coalesce(df[lang_col].cast("string"), F.lit("und"))
    return df.select(text.cast("binary").alias("raw"), lang.alias("lang"), F.pmod(F.xxhash64(lang), F.lit(SLOTS)).cast("int").alias("slot"),
                     F.pmod(F.xxhash64(df[id_col].cast("string"), text), F.lit(SHARDS)).cast("int").alias("shard"))


def _counted(parts):
    """Sorted keys with the slot of each and how often it occurs, from lists of (slots, keys)."""
    keys = np.concatenate([np.zeros(0, np.uint64), *[k for _, k in parts]])
    slots = np.concatenate([np.zeros(0, np.int32), *[s for s, _ in parts]])
    keys, first, n = np.unique(keys, return_index=True, return_counts=True)
    return slots[first], keys, n


def local_counts(rows: DataFrame, k: int, bitmaps=()) -> DataFrame:
    """slot, key (the shard in its low bits), n: phrases of k words by shard, if their words and parts are in the bitmaps of the levels below.

    On the first level also one row per language and shard with its number of words: `lang` is set, and the key is the shard.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(list(bitmaps))
    schema = "lang string, slot int, key long, n long"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        waiting, n_waiting, totals = [], 0, {}

        def flush():
            slots, keys, n = _counted(waiting)
            for at in range(0, len(keys), 1 << 18):
                cut = slice(at, at + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(keys[cut]), pa.string()), pa.array(slots[cut].astype(np.int32)), pa.array(keys[cut].view(np.int64)),
                                                  pa.array(n[cut].astype(np.int64))], schema=out)
        for batch in batches:
            lang, slot_of, shard_of = batch.column("lang").to_pylist(), batch.column("slot").to_numpy(), batch.column("shard").to_numpy()
            for block in blocks(batch.column("raw").to_pylist()):
                slots, shards = slot_of[block.owner], shard_of[block.owner].astype(np.uint64)
                if k == 1:
                    for owner, n in zip(*np.unique(block.owner, return_counts=True)):
                        key = lang[owner], int(slot_of[owner]), int(shard_of[owner])
                        totals[key] = totals.get(key, 0) + int(n)
                has = lambda level, keys, first: in_bitmap(sent.value[level - 1], keys | shards[first]) if level < k else np.ones(len(keys), bool)
                *_, (_, first, keys) = phrases_of(block, block.hashes(), slots, k, has)
                waiting.append((slots[first], keys | shards[first]))
                n_waiting += len(first)
                if n_waiting >= GATHER:
                    yield from flush()
                    waiting, n_waiting = [], 0
        yield from flush()
        if totals:
            names, slots, shards = zip(*totals)
            yield pa.RecordBatch.from_pydict({"lang": names, "slot": slots, "key": shards, "n": list(totals.values())}, schema=out)
    return rows.mapInArrow(run, schema).groupBy("lang", "slot", "key").agg(F.sum("n").alias("n"))


def bitmap(keys: DataFrame, drop_shard: bool) -> np.ndarray:
    """Keys (one column, stored) as bits, with or without their shard; it is sized by their number, up to `BITS`."""
    n_bits = 1 << max(15, min(BITS.bit_length() - 1, (BITS_PER_KEY * keys.count()).bit_length()))
    key = F.col(keys.columns[0])
    key = F.shiftrightunsigned(key, SHARD_BITS) if drop_shard else key
    at = key.bitwiseAND(F.lit(n_bits - 1)) + 1
    filled = (keys.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bitmap"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))
    bits = np.zeros(n_bits // 8, np.uint8)
    found = filled.toArrow()  # at most BITS / 8 bytes in all
    for place, part in zip(found["bitmap"].to_pylist(), found["bits"].to_pylist()):
        bits[(place - 1) * BITMAP // 8:place * BITMAP // 8] = np.frombuffer(part, np.uint8)
    return bits


def mine(rows: DataFrame, support: int, longest: int):
    """Every shard mined completely: the bitmap of the union of locally frequent phrases for each length, and words per language."""
    counts = cut_lineage(local_counts(rows, 1))
    totals = counts.where("lang IS NOT NULL").select("lang", "slot", F.col("key").alias("shard"), F.col("n").alias("words"))
    of_lang = totals.groupBy("lang").agg(F.sum("words").alias("n"))
    share = F.ceil(F.col("words").cast("decimal(20,0)") * support / F.col("n").cast("decimal(20,0)"))
    # At most SLOTS * SHARDS rows; languages that share a place take the lower threshold.
    least = cut_lineage(totals.join(own_shuffle(of_lang), "lang").groupBy("slot", "shard").agg(F.min(F.greatest(share, F.lit(1))).cast("long").alias("least")))
    local, union = [], []
    for k in range(1, longest + 1):
        counts = counts if k == 1 else local_counts(rows, k, local)
        by_shard = counts.where("lang IS NULL").withColumn("shard", F.col("key").bitwiseAND(F.lit(SHARDS - 1).cast("long")))
        frequent = cut_lineage(by_shard.join(F.broadcast(least), ["slot", "shard"]).where("n >= least").select("key"))
        union.append(bitmap(frequent, True))
        if k < longest:
            local.append(bitmap(frequent, False))
    return union, of_lang


class Words(dict):
    """The words that a task knows, by language and bytes, numbered as they come."""

    def number(self, block, langs, hashes, second):
        """The number of each word of a block; hashes find equal words, and the second hash and the length show that they are equal."""
        mixed = mix(hashes + OF_PLACE[7] * langs.astype(np.uint64))
        _, first, place = np.unique(mixed, return_index=True, return_inverse=True)
        lengths = block.end - block.start
        if (second == second[first][place]).all() and (lengths == lengths[first][place]).all() and (langs == langs[first][place]).all():
            words = [self.setdefault((lang, block.word(i)), len(self)) for lang, i in zip(langs[first].tolist(), first.tolist())]
            return np.array(words, np.int64)[place] if len(words) else np.zeros(0, np.int64)
        return np.array([self.setdefault((lang, block.word(i)), len(self)) for i, lang in enumerate(langs.tolist())], np.int64)


def count_candidates(rows: DataFrame, union, support: int) -> DataFrame:
    """lang, phrase, n_words, f: exact counts over all rows of all candidates that reach the support. Any phrase that does is a candidate."""
    spark, longest = rows.sparkSession, len(union)
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(union)
    schema = "lang string, phrase string, n_words int, f long"
    out = to_arrow_schema(StructType.fromDDL(schema))
    if longest > 3:
        raise ValueError("phrases of at most 3 words: three numbers of KNOWN words fit 63 bits")

    def run(batches):
        names, known, waiting, n_waiting = {}, Words(), {k: [] for k in range(1, longest + 1)}, 0

        def flush():
            langs, words = list(names), [None] * len(known)
            for (lang, word), i in known.items():
                words[i] = langs[lang], word.decode()
            for k, parts in waiting.items():
                ids, n = np.unique(np.concatenate([np.zeros(0, np.int64), *parts]), return_counts=True)
                for at in range(0, len(ids), 1 << 17):
                    some = ids[at:at + (1 << 17)]
                    columns = [((some >> (21 * (k - 1 - j))) & ((1 << 21) - 1)).tolist() for j in range(k)]
                    found = [words[i] for i in columns[0]]
                    phrases = [" ".join([words[i][1] for i in ids]) for ids in zip(*columns)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang for lang, _ in found], pa.string()), pa.array(phrases, pa.string()),
                                                      pa.array(np.full(len(some), k, np.int32)), pa.array(n[at:at + (1 << 17)].astype(np.int64))], schema=out)
        for batch in batches:
            lang_of = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.int64)
            slot_of = batch.column("slot").to_numpy()
            for block in blocks(batch.column("raw").to_pylist()):
                hashes = block.hashes()
                has = lambda level, keys, first: in_bitmap(sent.value[level - 1], keys >> np.uint64(SHARD_BITS))
                found = [(k, first) for k, first, _ in phrases_of(block, hashes, slot_of[block.owner], longest, has)]
                second = block.hashes(1)
                for at in range(0, len(hashes), KNOWN):  # one round, but for a piece of very many words
                    if n_waiting >= GATHER or len(known) >= KNOWN:
                        yield from flush()
                        names, known, waiting, n_waiting = {}, Words(), {k: [] for k in waiting}, 0
                        lang_of = np.array([names.setdefault(x, len(names)) for x in batch.column("lang").to_pylist()], np.int64)
                    within = lambda first, more: first[np.searchsorted(first, at):np.searchsorted(first, at + KNOWN + more)]
                    words = within(found[0][1], longest - 1)  # only candidates get a number
                    numbers = np.zeros(min(len(hashes) - at, KNOWN + longest), np.int64)
                    numbers[words - at] = known.number(Chosen(block, words), lang_of[block.owner[words]], hashes[words], second[words])
                    for k, first in found:
                        first = within(first, 0)
                        ids = numbers[first - at]
                        for j in range(1, k):
                            ids = ids << 21 | numbers[first - at + j]
                        waiting[k].append(ids)
                        n_waiting += len(first)
        yield from flush()
    counted = rows.mapInArrow(run, schema).groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f"))
    return counted.where(F.col("f") >= support)


class Chosen:
    """Some of a block's words."""

    def __init__(self, block, places):
        self.start, self.end, self.data = block.start[places], block.end[places], block.data

    word = Block.word


def scored(counts: DataFrame, share: int, longest: int) -> DataFrame:
    """lang, phrase, a, l, r, score of the candidates (phrases of two or more words) that no longer one makes up `share` percent of."""
    long = counts.where("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    part = lambda first, n: F.array_join(F.slice("words", first, n), " ")
    # A longer phrase's parts of two words or more, each with the most that one of them occurs.
    width, at = F.col("width"), F.col("at")
    inner = (long.where("n_words > 2").withColumn("width", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)))
             .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("n_words") - width + 1)))
             .select("lang", part(at, width).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    left = long.join(own_shuffle(inner), ["lang", "phrase"], "left").where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share))
    cuts = left.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    cuts = cuts.select("lang", "phrase", "a", "cut", "salt", part(F.lit(1), F.col("cut")).alias("first"), part(F.col("cut") + 1, F.col("n_words") - F.col("cut")).alias("second"))
    parts = counts.where(F.col("n_words") < longest).select("lang", F.col("phrase").alias("part"), "f", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    side = lambda name, count: own_shuffle(parts.withColumnsRenamed({"part": name, "f": count}))
    both = cuts.join(side("first", "l"), ["lang", "first", "salt"]).join(side("second", "r"), ["lang", "second", "salt"])
    wide = lambda c: F.col(c).cast("decimal(14,0)")
    both = both.withColumn("above", wide("a") * wide("a") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("below", wide("l") * wide("r"))
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(F.expr("above div below").alias("score"), "cut", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """Each language's `top` rows with their rank: the first of parts of it, then the first of those."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    few = rows.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    # At most PARTS * top rows per language from here on.
    return few.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def collocations(df: DataFrame, support=10, longest=3, share=50, top=2000, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best collocations of each language."""
    rows = prepared(df, id_col, text_col, lang_col)
    union, words = mine(rows, support, longest)
    counts = cut_lineage(count_candidates(rows, union, support))
    best = first_of_each(scored(counts, share, longest), top)
    return best.join(own_shuffle(words), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_SQL = """
    WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
    p AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
          FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d)),
    w AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
    grams AS (SELECT lang, 1 AS k, w[i] AS phrase FROM w
              UNION ALL SELECT lang, 2, w[i] || ' ' || w[i + 1] FROM w WHERE i + 1 <= len(w)
              UNION ALL SELECT lang, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM w WHERE i + 2 <= len(w)),
    n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
    c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
    longer AS (SELECT lang, phrase, max(a) AS most FROM (SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
    kept AS (SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a),
    cuts AS (SELECT lang, phrase, a, unnest(range(1, k)) AS cut, w FROM kept),
    halves AS (SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y FROM cuts),
    s AS (SELECT h.lang, h.phrase, a, cut, x.f AS l, y.f AS r, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
          FROM halves h JOIN f x ON x.lang = h.lang AND x.phrase = h.x JOIN f y ON y.lang = h.lang AND y.phrase = h.y),
    best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM best JOIN n USING (lang) QUALIFY rank <= 2000"""


@query(_SQL)
def op11_collocations(spark, sf_dir):
    """The best collocations of two or three words in all documents, by language."""
    return collocations(table(spark, sf_dir, "documents"))
