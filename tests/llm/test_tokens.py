"""Token counts, piece codec and packing against the libraries, and packing against its rules."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from courtledger.llm import packing, piece_codec, token_counts
from courtledger.llm.pretokens import Cache, Splitter

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a  b\n\x00c <s> ▁x é́ 日本 \U0001f600", "<|endoftext|> a<|endoftext|>b<|startoftext|>", "İΣας ΑΣ", "  " * 50 + "x", " " * 31,
       "it's we'LL don't'S", "\n\n\n a \t\tb", "\x1c\x1d a\x85b\xa0c", "a" * 20_000, "日本語" * 1000, "￿\U000e0080 x", "word " * 5000]
TEXT = st.text(alphabet=st.one_of(st.sampled_from(list("aeinrst AB'.,1\n▁é日Σ")), st.characters(exclude_categories=["Cs"])), max_size=60)


@pytest.fixture(scope="module")
def library():
    return {n: Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def splitters():
    return {n: Splitter(token_counts.read_spec(public_tokenizers.path(n))) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


@pytest.fixture(scope="module")
def codec():
    return piece_codec.Codec(piece_codec.read_model(MODEL), cache=50, pairs=500)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_any_text(library, splitters, codec, pieces, text):
    for name, splitter in splitters.items():
        want = library[name].encode(text, add_special_tokens=False).ids
        assert packing.text_ids(text, splitter, Cache(splitter, packing._as_bytes, limit=20)) == packing._as_bytes(want)
        assert token_counts.count_tokens(text, splitter, Cache(splitter, len, limit=20)) == len(want)
    want = pieces.encode(text, add_bos=True, add_eos=True)
    assert codec.encode(text) == packing._as_bytes(want) and codec.decode(codec.encode(text)) == pieces.decode(want)


def test_prefix_table(codec):
    for word in ("▁internationalisation", "▁theandofther", "aaaaaaaaaaaaa", "▁Straßenbahn"):
        assert codec.known(word) == codec.merged(word)


def test_frequent_table(splitters):
    table = token_counts.unpacked(token_counts.frequent_lengths(token_counts.read_spec(public_tokenizers.path("byte_bpe_50k.json")), 500))
    assert len(table) == 500 and all(len(splitters["byte_bpe_50k.json"].encode(t)) == n for t, n in table.items())


def test_queries(spark, written, real, library, pieces):
    pairs = [*enumerate(ODD), *((i + 100, t) for i, t in real[:60]), (2, " "), (None, "x")]
    path, texts = written(pairs), {i: t or "" for i, t in pairs}
    counts = token_counts.op7_token_counts(spark, path).collect()
    coded = piece_codec.op8_piece_codec(spark, path).collect()
    packed = packing.op4_best_two_fit(spark, path).collect()
    assert len(counts) == len(coded) == len(pairs)
    for row in counts:
        n = len(library["byte_bpe_50k.json"].encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[row.doc_id].encode()), n, n > 1024)
    for row in coded:
        ids = pieces.encode(texts[row.doc_id], add_bos=True, add_eos=True)
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(pieces.decode(ids).encode()).hexdigest()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in packed:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append((row.offset, row.length))
    assert set(by_doc) == set(texts)
    for doc_id, rows in by_doc.items():
        ids = np.array(library["word_bpe_49k.json"].encode(texts[doc_id], add_special_tokens=False).ids + [0], "<u4")
        for row in rows:
            cut = ids[row.start:row.start + row.length]
            assert row.start == 2048 * row.piece and row.ids_crc32 == zlib.crc32(cut.tobytes())
        assert sum(r.length for r in rows) == len(ids) * (2 if doc_id == 2 else 1)
    for rows in by_sequence.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 2048
    for query in (token_counts.op7_token_counts, piece_codec.op8_piece_codec, packing.op4_best_two_fit):
        assert query(spark, written([])).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_best_two_fit(lengths):
    sequence, offset = packing.best_two_fit(lengths, 64)
    used = defaultdict(list)
    for n, s, o in zip(lengths, sequence, offset):
        used[s].append((o, n))
    for rows in used.values():
        ends = np.cumsum([n for _, n in sorted(rows)])
        assert [o for o, _ in sorted(rows)] == [0, *ends[:-1]] and ends[-1] <= 64
    # Two sequences that fit into one are never both made.
    fills = sorted(sum(n for _, n in rows) for rows in used.values())
    assert len(fills) < 2 or fills[0] + fills[1] > 64


def test_two_for_one():
    # Greedily 6 + 3 leaves a gap of 1; 2 + 2 in place of the 3 fill it.
    sequence, _ = packing.best_two_fit([6, 3, 2, 2], 10)
    assert sequence[0] == sequence[2] == sequence[3] != sequence[1]
    assert packing.tightest_pair(np.bincount([5, 5, 4], minlength=12), 9) == (4, 5) and packing.tightest_pair(np.bincount([5], minlength=12), 11) == (0, 0)


def test_packing_is_tight():
    lengths = np.clip(np.random.default_rng(1).lognormal(6, 1, 5000).astype(int), 1, 2048)
    assert packing.best_two_fit(lengths, 2048)[0].max() + 1 <= np.ceil(lengths.sum() / 2048) * 1.002 + 1


def test_decoding_of_null_ids(spark):
    got = piece_codec.decode_ids(spark.createDataFrame([(1, None), (2, bytearray())], "doc_id long, ids binary"), MODEL)
    assert [r.text for r in got.collect()] == ["", ""]


def test_decoding_like_the_library():
    """Any ids, bytes in the midst of characters among them; and one pass gives what encoding and decoding do."""
    rng, codec, library = np.random.default_rng(8), piece_codec.Codec(piece_codec.read_model(MODEL), cache=50), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for _ in range(2000):
        ids = np.where(rng.random(n := rng.integers(0, 12)) < 0.5, rng.integers(0, 300, n), rng.integers(0, 32_000, n))
        assert codec.decode(ids.astype("<u4").tobytes()) == library.decode(ids.tolist()), ids
    assert codec.decode(np.array([1, 99_999, 2], "<u4").tobytes()) == ""
    for text in ["", " ", "a", "  b  c ", "naïve 東京 ͸\n\n", "x" * 200 + " y", "a▁b"]:
        ids, raw = codec.round_trip(text)
        assert ids == codec.encode(text) == np.array([1, *library.encode(text), 2], "<u4").tobytes() and raw.decode() == codec.decode(ids) == library.decode(library.encode(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40), st.integers(2, 60))
def test_tightest_pair_of_all_pairs(lengths, room):
    left = np.bincount(lengths, minlength=room + 1)
    sums = [a + b for i, a in enumerate(lengths) for b in lengths[i + 1:] if a + b <= room]
    first, second = packing.tightest_pair(left, room)
    assert first + second == max(sums, default=0)
    if first:
        assert left[first] and left[second] and (first != second or left[first] > 1)


def test_words_between_white_space(monkeypatch):
    """Words are remembered as a whole: far fewer look-ups than pieces, and the library's ids whatever white space there is."""
    name = public_tokenizers.path("word_bpe_49k.json")
    splitter = Splitter(token_counts.read_spec(name))
    encoded = Cache(splitter, packing._as_bytes)
    words = packing.words_of(splitter, encoded, 8)
    for text in ["", " ", "it's e-mail, (twice) it's", "a\x1cb \x1f c\x85d\xa0e\u2028f", "\tA  \n B\r\n", "é\u0301 ΑΣ Σ <|endoftext|> x<|endoftext|>", "\u200b中文9 9.5"]:
        assert packing.text_ids(text, splitter, encoded, words) == packing._as_bytes(splitter.encode(text))
    monkeypatch.setattr(splitter, "find", None)  # known words are not split again
    known = packing.words_of(splitter, encoded)
    known.learn("e-mail,", b"1234")
    assert packing.text_ids(" e-mail, e-mail,", splitter, encoded, known) == b"12341234"
