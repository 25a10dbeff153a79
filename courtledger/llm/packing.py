"""Best-two-fit packing of token pieces into sequences.

A document's ids, with an end id after them, are cut only where they are longer than a sequence. Pieces are dealt by a
hash of document and piece into packing groups of about `GROUP` pieces, and each group fills its own sequences: greedily,
the largest piece that fits first; then, if a gap is left, the smallest piece of the sequence is taken out again for the
two unpacked pieces that fill its gap and the old one most tightly, if they do so better than it did. A group leaves at most
one or two sequences part-filled, so nearly nothing is lost to dealing, and no task grows with the input. Only ids and
lengths are shuffled, never texts.

Defined cases: a null or empty text is one piece with the end id alone; repeated rows are packed as often as they occur;
an empty table gives an empty table; other columns are ignored. Ties are broken by document, then piece.
"""

import re
import struct
import zlib
from math import ceil

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, map_batches, registry, table, texts_of
from .pretokens import CACHE, Cache, Recent, Splitter, of_worker, unassigned
from .token_counts import read_spec

QUERIES, SQL, query = registry()

SEQUENCE, END_ID, GROUP = 2048, 0, 16_384
#: Words that a worker remembers (or twice as many, see Recent).
WORDS = 500_000
SEPARATORS = re.compile("[\x1c-\x1f]")


def _as_bytes(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def words_of(splitter: Splitter, encoded: Cache, limit=WORDS) -> Recent:
    """Ids of what stands between two spaces in a normalised text, from those of its pieces."""
    return Recent(limit, lambda word: b"".join([encoded[piece] for piece in splitter.find(word)]))


def text_ids(text: str, splitter: Splitter, encoded: Cache, words: Recent | None = None) -> bytes:
    """The ids of a whole text, little-endian 32-bit, exactly those of the library. With `words`, each word between white space is looked up
    as one if the tokenizer drops white space: then no piece holds any, and a word's pieces do not depend on what is around it."""
    if unassigned(text):
        return _as_bytes(splitter.encode(text))
    out = []
    for part in splitter.parts(text):
        if part in splitter.special:
            out.append(_as_bytes([splitter.special[part]]))
        elif words is not None and splitter.drops_space:
            part = splitter.normalised(part)
            # Python takes four control characters for white space, too.
            out.extend(map(words.__getitem__, part.split(" ") if SEPARATORS.search(part) else part.split()))
        else:
            out.extend(map(encoded.__getitem__, splitter.pieces(part)))
    return b"".join(out)


def token_pieces(df: DataFrame, tokenizer: str, length=SEQUENCE, end_id=END_ID, id_col="doc_id", text_col="text", with_ids=False) -> DataFrame:
    """One row per piece: document, piece, start, length, CRC-32 of the ids, and the ids themselves on request."""
    sent = df.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def worker():
        splitter = Splitter(sent.value)
        encoded = Cache(splitter, _as_bytes, (), CACHE)
        return splitter, encoded, words_of(splitter, encoded)

    def step(batch):
        splitter, encoded, words = of_worker(("ids", tokenizer), worker)
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []))}
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            ids = text_ids(text, splitter, encoded, words) + _as_bytes([end_id])
            for piece, at in enumerate(range(0, len(ids), 4 * length)):
                cut = ids[at:at + 4 * length]
                for k, v in (("doc_id", doc_id), ("piece", piece), ("start", at // 4), ("length", len(cut) // 4), ("ids_crc32", zlib.crc32(cut))):
                    out[k].append(v)
                if with_ids:
                    out["ids"].append(cut)
        return out
    return map_batches(id_and_text(df, id_col, text_col), step,
                       "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def best_two_fit(lengths, capacity: int):
    """(sequence, offset) of each piece; pieces of one length are taken in the order given."""
    lengths = np.asarray(lengths, dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1)
    waiting = {int(n): list(order[lengths[order] == n][::-1]) for n in np.flatnonzero(left)}
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n_left, n_sequences = len(lengths), 0

    def largest(room):
        at = room
        some = left[:at + 1].nonzero()[0]
        return int(some[-1]) if len(some) else 0

    while n_left:
        chosen, gap = [], capacity
        while gap and (size := largest(gap)):
            chosen.append(size)
            left[size] -= 1
            gap -= size
        if gap and len(chosen) > 0:
            smallest = chosen[-1]
            pair = tightest_pair(left, gap + smallest)
            if sum(pair) > smallest:
                left[smallest] += 1
                chosen[-1:] = pair
                for size in pair:
                    left[size] -= 1
        at = 0
        for size in chosen:
            i = waiting[size].pop()
            sequence[i], offset[i] = n_sequences, at
            at += size
        n_left -= len(chosen)
        n_sequences += 1
    return sequence, offset


def tightest_pair(left, room: int):
    """The two lengths still waiting whose sum comes closest to `room` from below; (0, 0) if no two fit."""
    first = left[:room].nonzero()[0]
    if not len(first):
        return 0, 0
    # The best partner of a is the largest length that is still there and no longer than room - a.
    best = np.zeros(room + 1, np.int64)
    best[first] = first
    best = np.maximum.accumulate(best)
    partner = best[room - first]
    # A length that is there once cannot be its own partner: the next smaller one is.
    alone = (partner == first) & (left[first] < 2)
    partner[alone] = best[first[alone] - 1] if alone.any() else 0
    total = np.where(partner > 0, first + partner, 0)
    i = int(total.argmax())
    return (int(first[i]), int(partner[i])) if total[i] else (0, 0)


def pack(pieces: DataFrame, capacity=SEQUENCE, n_groups=1) -> DataFrame:
    """The pieces with `sequence_id` and `offset`. `pieces` has doc_id, piece and length; other columns are kept."""
    group = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_groups)).cast("long")
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset", "pack_group")]

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece"], kind="stable")
        sequence, offset = best_two_fit(rows["length"].to_numpy(), capacity)
        return rows.assign(sequence_id=rows["pack_group"].to_numpy() * (1 << 32) + sequence, offset=offset).drop(columns="pack_group")
    grouped = pieces.select(*keep, group.alias("pack_group"))
    schema = pieces.select(*keep).schema.add("sequence_id", "long").add("offset", "long")
    return grouped.groupBy("pack_group").applyInPandas(fill, schema)


def pack_documents(docs: DataFrame, tokenizer: str, length=SEQUENCE, id_col="doc_id", text_col="text") -> DataFrame:
    n_groups = max(1, ceil(docs.count() / GROUP))
    return pack(token_pieces(docs, tokenizer, length, END_ID, id_col, text_col), length, n_groups)


@query()
def op4_best_two_fit(spark, sf_dir):
    """All documents as pieces in sequences."""
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
