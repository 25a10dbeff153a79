"""Token counts by a map-side two-tier look-up.

Tier one is a compact hash table from frequent pieces to their number of tokens, built once from the vocabulary and sent
to every worker: by construction a vocabulary holds the strings that were most frequent where it was made, so its entries
that are whole pieces are the frequent ones. It has at most `TABLE` entries, whatever the corpus. Tier two is the cache of
each worker: a piece outside of the table is encoded once and remembered, at most `CACHE` of them. Pieces never leave the
task that read them: one scan, no shuffle.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows are each counted; an empty table gives an
empty table; columns other than id and text are ignored. Texts are counted whole, however long.
"""

import struct

import public_tokenizers
from pyspark.sql import DataFrame

from .common import id_and_text, map_batches, registry, table, texts_of
from .pretokens import CACHE, Cache, Splitter, of_worker, unassigned

QUERIES, SQL, query = registry()

TABLE = 65_536
LIMIT = 1024


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def frequent_lengths(spec: str, size: int = TABLE) -> bytes:
    """The pieces among the vocabulary's entries with their numbers of tokens, earliest merges first: length, bytes, count."""
    splitter, packed, n = Splitter(spec), [], 0
    decoded = splitter.tokenizer.decode_batch([[i] for i in range(splitter.tokenizer.get_vocab_size(with_added_tokens=False))], skip_special_tokens=False)
    for text in decoded:
        if n < size and text and "�" not in text and text not in splitter.special and splitter.pieces(text) == [text]:
            raw = text.encode()
            packed.append(struct.pack("<HB", len(raw), len(splitter.encode(text))) + raw)
            n += 1
    return b"".join(packed)


def unpacked(packed: bytes) -> dict:
    lengths, at = {}, 0
    while at < len(packed):
        n, count = struct.unpack_from("<HB", packed, at)
        lengths[packed[at + 3:at + 3 + n].decode()] = count
        at += 3 + n
    return lengths


def count_tokens(text: str, splitter: Splitter, lengths: Cache) -> int:
    if unassigned(text):
        return len(splitter.encode(text))
    total, look = 0, lengths.__getitem__
    for part in splitter.parts(text):
        total += 1 if part in splitter.special else sum(map(look, splitter.pieces(part)))
    return total


def token_counts(df: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", table_size=TABLE, cache=CACHE) -> DataFrame:
    """One row per row: the id, bytes in UTF-8 and tokens of the whole text."""
    spec = read_spec(tokenizer)
    sent = df.sparkSession.sparkContext.broadcast((spec, frequent_lengths(spec, table_size)))

    def worker():
        spec, packed = sent.value
        splitter = Splitter(spec)
        return splitter, Cache(splitter, len, unpacked(packed), cache)

    def step(batch):
        splitter, lengths = of_worker(("lengths", tokenizer, table_size, cache), worker)
        texts = texts_of(batch)
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t) if t.isascii() else len(t.encode()) for t in texts],
                "n_tokens": [count_tokens(t, splitter, lengths) for t in texts]}
    return map_batches(id_and_text(df, id_col, text_col), step, "doc_id long, n_bytes long, n_tokens long")


@query()
def op7_token_counts(spark, sf_dir):
    """Bytes and tokens of all documents, and whether they are over the limit."""
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", counts.n_tokens > LIMIT)
