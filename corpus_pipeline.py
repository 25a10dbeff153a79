"""The corpus pipeline: documents without toxic texts, copies and personal data, packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
documents. All but the last return the columns that they were given.
"""

import public_tokenizers

from courtledger.llm import dedup, near_dedup, packing, pii, toxicity
from courtledger.llm.common import table
from courtledger.session import scratch_path


def without_toxic(spark, docs, sf_dir):
    """Documents whose whole text scores below 0.5; the labels train the score and decide nothing themselves."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark, docs, sf_dir):
    """Of equal texts (A-Z lower-cased) the one with the largest id."""
    return dedup.drop_copies(docs)


def without_near_copies(spark, docs, sf_dir):
    """One document of each group linked by similarities of 0.8 or more on five-word shingles."""
    return near_dedup.keep_one(docs, n_words=5, percent=80)


def without_personal_data(spark, docs, sf_dir):
    """All documents, with personal data replaced by its kind."""
    return pii.redact_texts(docs)


def packed(spark, docs, sf_dir):
    """Pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

#: A trained classifier and a tokenizer are beyond SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
