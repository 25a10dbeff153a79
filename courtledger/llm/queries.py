"""The registered queries of this subpackage, one per operator."""

from importlib import import_module

MODULES = ("secret_scan", "dedup", "pii", "packing", "near_dedup", "warc", "token_counts", "piece_codec", "fingerprints", "toxicity", "quality_rules", "token_alignment", "phrases")


def _registered(kind):
    found = {}
    for name in MODULES:
        found.update(getattr(import_module(f"courtledger.llm.{name}"), kind))
    return found


def all_queries():
    return _registered("QUERIES")


def all_sql():
    return _registered("SQL")
