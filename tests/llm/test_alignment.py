"""Alignment of two tokenizers against a plain version made with the libraries alone."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from courtledger.llm import token_alignment as ta
from courtledger.llm.piece_codec import model_bytes
from courtledger.llm.pretokens import Recent, byte_letters
from courtledger.llm.token_counts import read_spec

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

ODD = [
    (1, None), (2, ""), (3, " "), (4, "one"), (5, "one"), (6, "a▁b and more"), (7, "<|endoftext|> and <s> <0x41> </s>"), (None, "no id at all"),
    (None, "no id at all"), (8, "\n\n  several   spaces \t and\r\nlines   　 x"), (9, "naïve — “quoted” 東京タワー 👩‍👩‍👧 ͸ é"), (10, "\x00\x01 ab"),
    (11, "x" * 3000 + " " + "ab" * 500), (12, "word " * 4000), (13, "don't we'll I'm 12345 3.14 a_b"), (13, "another text for one id"), (14, "  leading and trailing  "),
]


def plain(docs):
    """Every pair of tokens is compared with every other one near it, with the libraries' own ids."""
    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {byte_letters().get(b, chr(b)): b for b in range(256)}
    spell_a = {i: bytes(byte_of[c] for c in t) for t, i in a_tok.get_vocab(with_added_tokens=False).items() if all(c in byte_of for c in t)}

    def spell_b(i):
        return bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()

    rows = []
    for doc_id, text in docs:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        parts_a, parts_b = [spell_a[i] for i in a], [spell_b(i) for i in b]
        raw = b" " + (text or "").encode()
        if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            rows.append((doc_id, [], [], [], []))
            continue
        spans = lambda parts: [(sum(map(len, parts[:i])), sum(map(len, parts[:i + 1]))) for i in range(len(parts))] if len(parts) < 400 else _spans(parts)
        at_a, at_b = spans(parts_a), spans(parts_b)
        links = [(x, y) for x, (s, e) in zip(a, at_a) for y, (t, f) in zip(b, at_b) if s < f and t < e] if len(a) < 400 else _links(a, at_a, b, at_b)
        ends = sorted({e for _, e in at_a} & {e for _, e in at_b})
        groups = [([x for x, (s, e) in zip(a, at_a) if lo <= s and e <= hi], [y for y, (s, e) in zip(b, at_b) if lo <= s and e <= hi])
                  for lo, hi in zip([0, *ends], ends)] if len(ends) < 400 else _groups(a, at_a, b, at_b, ends)
        rows.append((doc_id, a, b, groups, links))
    counts = Counter(p for r in rows for p in r[4])
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return [(i, len(a), len(b), len(g), len(ls), sum(counts[p] == best[p[1]] for p in ls), sum(counts[p] for p in ls),
             hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest() if a else "")
            for i, a, b, g, ls in rows]


def _spans(parts):
    found, at = [], 0
    for p in parts:
        found.append((at, at + len(p)))
        at += len(p)
    return found


def _links(a, at_a, b, at_b):
    """By byte: which token of either holds it."""
    of = lambda spans: [k for k, (s, e) in enumerate(spans) for _ in range(e - s)]
    return [(a[x], b[y]) for x, y in sorted(set(zip(of(at_a), of(at_b))))]


def _groups(a, at_a, b, at_b, ends):
    group = {e: k for k, e in enumerate(ends)}
    found = [([], []) for _ in ends]
    for side, (ids, spans) in enumerate(((a, at_a), (b, at_b))):
        k = 0
        for x, (_, e) in zip(ids, spans):
            found[k][side].append(x)
            k = k + 1 if e in group else k
    return found


def found_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@pytest.mark.parametrize("size", [ta.TABLE, 50, 0])
def test_like_the_plain_version(docs_of, size):
    df = ta.aligned_with_counts(docs_of(ODD), A, B, size=size)
    assert found_rows(df) == sorted(plain(ODD), key=str)
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint", "n_best": "bigint",
                               "count_sum": "bigint", "groups_sha256": "string"}


def test_real_documents(spark, docs_of, real):
    df = ta.aligned_with_counts(docs_of(real), A, B, size=500)
    assert found_rows(df) == sorted(plain(real), key=str)


def test_no_documents(docs_of):
    assert ta.aligned_with_counts(docs_of([]), A, B).collect() == []
    assert found_rows(ta.aligned_with_counts(docs_of([(1, None), (2, "")]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_groups_spell_the_text(docs_of, real):
    """Whatever the windows are, the groups' ids in their order are the ids of either tokenizer."""
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    texts = dict(real[:60])
    for r in ta.align_texts(docs_of(list(texts.items())), A, B, with_groups=True).collect():
        groups = [[[int(i) for i in side.split(",")] for side in g.split("|")] for g in r["groups"].split(";")] if r["groups"] else []
        if groups:
            assert [i for g in groups for i in g[0]] == a_tok.encode(" " + texts[r["doc_id"]], add_special_tokens=False).ids
            assert [i for g in groups for i in g[1]] == b_tok.encode(texts[r["doc_id"]])
            assert r["n_links"] == sum(r["times"]) == sum(len(x) + len(y) - 1 for x, y in groups)


def test_windows_are_forgotten_without_harm(real):
    spec, model = read_spec(A), model_bytes(B)
    few, many = ta.Aligner(spec, model, windows=3), ta.Aligner(spec, model)
    texts = [t for _, t in real[:20]]
    assert [d and d[:5] for d in few.documents(texts)] == [d and d[:5] for d in many.documents(texts)]


def test_recent():
    made = []
    recent = Recent(2, lambda key: made.append(key) or key.upper())
    for key in "abca":
        assert recent[key] == key.upper()
    assert made == ["a", "b", "c"]  # "a" was remembered anew when it was asked for
    assert [recent[key] for key in "da"] == ["D", "A"] and made == ["a", "b", "c", "d"]
    assert recent["b"] == "B" and made[-1] == "b"
