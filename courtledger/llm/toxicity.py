"""Toxicity by non-negative positive-unlabelled learning in numpy.

Confirmed toxic examples are the positives; a sample of texts whose labels are not looked at is the unlabelled set, and
the share of positives among labelled rows is the class prior. A linear model is trained on the corrected risk: what the
positives would add as negatives is taken off the unlabelled risk, and where that difference falls below zero the step
goes the other way, so that it cannot be fitted away (Kiryo et al. 2017). Inputs are words and the beginnings of words,
hashed; their counts are divided by the square root of the text's length. Features that are in few positives are
dropped. Training uses at most `SAMPLE` labelled rows, taken by a hash of their id, which reach the driver packed; the model
is a table of fixed size.

Defined cases: a null or empty text has the score of no features; repeated rows are each scored, and repeated labels
count once, toxic if one of them says so; null labels are no labels; without positives every score is 0; an empty
table gives an empty table; columns other than id and text are never read for a score.
"""

import re
import zlib
from math import ceil

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, map_batches, registry, table, texts_of
from .pretokens import of_worker

QUERIES, SQL, query = registry()

#: Labelled rows that a model is trained on, at most.
SAMPLE = 12_000
BITS, SCALE = 18, 3.0
PREFIXES = (4, 5, 6, 7)
#: Passes over the sample, more of them for a small one, so that as many steps are made; the last quarter is averaged.
EPOCHS, STEPS, RATE, DECAY, BATCH, POSITIVES = 20, 460, 0.02, 3e-4, 512, 64
HOLD_OUT = 5
WORD = re.compile(r"[^\W\d_]+")
#: Words whose score a worker remembers.
CACHE = 400_000


def words(text: str) -> list:
    return WORD.findall(text.lower())


def features(word: str) -> set:
    """Hashes of the word and of its beginnings."""
    grams = {f"^{word}$"} | {f"^{word[:k]}" for k in PREFIXES if len(word) >= k}
    return {zlib.crc32(g.encode()) & ((1 << BITS) - 1) for g in grams}


def counted(text: str, cache: dict):
    """Features of a text with their counts, and the number of its words."""
    found, total = {}, 0
    for word in words(text):
        total += 1
        of_word = cache.get(word)
        if of_word is None:
            of_word = cache[word] = features(word)
        for f in of_word:
            found[f] = found.get(f, 0) + 1
        if len(cache) > CACHE:
            cache.clear()
    ids = np.fromiter(found, np.uint32, len(found))
    order = np.argsort(ids)
    counts = np.fromiter(found.values(), np.int64, len(found))[order]
    return ids[order], np.minimum(counts, 65_535).astype(np.uint16), total


def packed(ids, counts) -> bytes:
    """Sorted ids with their counts in about a quarter of their bytes."""
    return zlib.compress(np.diff(ids, prepend=np.uint32(0)).tobytes() + counts.tobytes(), 1)


def unpacked(found):
    raw = zlib.decompress(found)
    n = len(raw) // 6
    return np.cumsum(np.frombuffer(raw, np.uint32, n), dtype=np.uint32), np.frombuffer(raw, np.uint16, n, 4 * n)


class PackedRows:
    """Rows of (ids, counts, words) that are unpacked one at a time, as they are asked for."""

    def __init__(self, found, totals):
        self.found, self.totals = found, totals

    def __len__(self):
        return len(self.found)

    def __getitem__(self, i):
        return *unpacked(self.found[i]), self.totals[i]


def held_out(id_column):
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(HOLD_OUT)) == 0


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Rows:
    """Sparse rows of the used features, one after the other in two flat arrays."""

    def __init__(self, rows, used):
        self.ends = np.concatenate([[0], np.cumsum([int(used[ids].sum()) for ids, _, _ in rows])]).astype(np.int64)
        # One block: the system gets a large one back as a whole, while parts of it stay with the process.
        block = np.empty((2, self.ends[-1]), np.int32)
        self.ids, self.values = block[0], block[1].view(np.float32)
        for i, (ids, counts, n) in enumerate(rows):
            kept, place = used[ids], slice(self.ends[i], self.ends[i + 1])
            self.ids[place] = ids[kept]
            self.values[place] = counts[kept] * (SCALE / np.sqrt(max(1, n)))

    def part(self, which):
        lengths = self.ends[which + 1] - self.ends[which]
        at = np.repeat(self.ends[which] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        return self.ids[at], self.values[at], np.repeat(np.arange(len(which)), lengths)


def pu_gradient(margin_p, margin_u, prior):
    """Derivatives of the corrected risk by the margins of positives and unlabelled rows, with logistic loss."""
    p, u = _sigmoid(margin_p), _sigmoid(margin_u)
    negative_risk = np.logaddexp(0, margin_u).mean() - prior * np.logaddexp(0, margin_p).mean()
    if negative_risk >= 0:
        return -prior * np.ones_like(p) / len(p), u / len(u)
    return prior * p / len(p), -u / len(u)


def train(rows, positive, seed=0):
    """Weights and bias from (ids, counts, words) of each row and whether it is a confirmed example."""
    positive = np.asarray(positive, dtype=bool)
    weights, width = np.zeros(1 << BITS), 1 << BITS
    n_positive = int(positive.sum())
    if not n_positive or n_positive == len(rows):
        return weights.astype(np.float32), 60.0 if n_positive else -np.inf
    prior = n_positive / len(rows)
    least = int(np.clip(0.006 * n_positive, 2, 8))
    support = np.bincount(np.concatenate([rows[i][0] for i in np.flatnonzero(positive)]).astype(np.int64), minlength=width)
    used = support >= least
    data = Rows(rows, used)
    rng, bias = np.random.default_rng(seed), float(np.log(prior / (1 - prior)))
    state = [np.zeros(width + 1), np.zeros(width + 1)]
    mean, n_mean = np.zeros(width + 1), 0
    confirmed, step = np.flatnonzero(positive), 0
    n_batches = max(1, len(rows) // BATCH)
    epochs = max(EPOCHS, ceil(STEPS / n_batches))
    for epoch in range(epochs):
        unlabelled = np.array_split(rng.permutation(len(rows)), n_batches)
        examples = np.array_split(rng.permutation(np.resize(confirmed, max(len(confirmed), n_batches * POSITIVES))), n_batches)
        for u, p in zip(unlabelled, examples):
            (ids_p, x_p, row_p), (ids_u, x_u, row_u) = data.part(p), data.part(u)
            z_p = bias + np.bincount(row_p, weights[ids_p] * x_p, len(p))
            z_u = bias + np.bincount(row_u, weights[ids_u] * x_u, len(u))
            g_p, g_u = pu_gradient(z_p, z_u, prior)
            g = np.bincount(ids_p, g_p[row_p] * x_p, width) + np.bincount(ids_u, g_u[row_u] * x_u, width) + DECAY * weights
            g = np.append(g, g_p.sum() + g_u.sum())
            step += 1
            state[0] = 0.9 * state[0] + 0.1 * g
            state[1] = 0.999 * state[1] + 0.001 * g * g
            move = RATE * (state[0] / (1 - 0.9 ** step)) / (np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-8)
            weights, bias = weights - move[:-1], bias - move[-1]
        if 4 * epoch >= 3 * epochs:
            mean, n_mean = mean + np.append(weights, bias), n_mean + 1
    mean /= n_mean
    return (mean[:-1] * SCALE).astype(np.float32), float(mean[-1])


class Scorer(dict):
    """Word to the sum of its features' weights; a text's score needs one look-up per word."""

    def __init__(self, weights, bias):
        super().__init__()
        self.weights, self.bias = weights, bias

    def __missing__(self, word):
        if len(self) >= CACHE:
            self.clear()
        value = float(sum(self.weights[f] for f in features(word)))
        self[word] = value
        return value

    def score(self, text: str) -> float:
        found = words(text)
        return float(_sigmoid(self.bias + sum(map(self.__getitem__, found)) / max(1, len(found)) ** 0.5)) if np.isfinite(self.bias) else 0.0


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", sample=SAMPLE):
    """(weights, bias) from at most `sample` labelled rows outside of the held-out fold."""
    chosen = (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
              .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # The sample has a fixed bound, so it may be sent to every task.
    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")

    def step(batch):
        cache, out = {}, {k: [] for k in ("doc_id", "label", "first", "found", "n")}
        for doc_id, label, text in zip(batch.column("doc_id").to_pylist(), batch.column("label").to_pylist(), texts_of(batch)):
            ids, counts, n = counted(text, cache)
            for k, v in (("doc_id", doc_id), ("label", label), ("first", ids[:16].tobytes()), ("found", packed(ids, counts)), ("n", n)):
                out[k].append(v)
        return out
    sent = map_batches(rows, step, "doc_id long, label int, first binary, found binary, n long").toArrow()
    doc_ids, labelled, firsts, totals = (sent.column(c).to_pylist() for c in ("doc_id", "label", "first", "n"))
    # Views of the collected bytes: the driver holds the sample packed, and once more as the rows that are trained on.
    found = [v.as_buffer() for chunk in sent.column("found").chunks for v in chunk]
    order = sorted(range(len(totals)), key=lambda i: (doc_ids[i], totals[i], firsts[i]))
    return train(PackedRows([found[i] for i in order], [totals[i] for i in order]), [labelled[i] == 1 for i in order])


def score(docs: DataFrame, model, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row: the id and the score of the whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = ("toxicity", zlib.crc32(model[0].tobytes()), model[1])

    def step(batch):
        scorer = of_worker(key, lambda: Scorer(*sent.value))
        return {"doc_id": batch.column("doc_id"), "score": [scorer.score(t) for t in texts_of(batch)]}
    return map_batches(id_and_text(docs, id_col, text_col), step, "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col="text", id_col="doc_id", threshold=0.5) -> DataFrame:
    """The rows whose text scores below the threshold, with all their columns as they were."""
    model = fit(docs, labels, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = ("toxicity", zlib.crc32(model[0].tobytes()), model[1])

    def step(batch):
        scorer = of_worker(key, lambda: Scorer(*sent.value))
        keep = [i for i, t in enumerate(texts_of(batch, text_col)) if scorer.score(t or "") < threshold]
        kept = batch.take(keep)
        return {n: kept.column(i) for i, n in enumerate(batch.schema.names)}
    return map_batches(docs, step, docs.schema.toDDL())


@query()
def op10_toxicity(spark, sf_dir):
    """Scores of all documents, learnt from the labels outside of the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
