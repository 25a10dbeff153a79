"""Encoding by merges, as a prefix table, and decoding.

The encoding of each prefix of a word ends in one token only. That token is found from left to right: an automaton gives
the vocabulary's pieces that end at a position, and the right one is the piece that may follow the last token of the
prefix before it, that is, the pair of both is not merged any further. Ids are recovered backwards from the end of the
word, piece by piece. Pieces hold a space mark only at their start, so words with the space before them are encoded one
by one and remembered per worker; runs of spaces follow a rule of their own.

Defined cases: a null or empty text has the begin and end ids and decodes to the empty text; repeated rows are each
encoded; an empty table gives an empty table; columns other than id and text are ignored. Texts are encoded whole. Ids that
the vocabulary does not have decode to nothing; of bytes that are no UTF-8, each decodes to U+FFFD, as in the library.
"""

import codecs
import hashlib
import re

import ahocorasick
import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2

from .common import id_and_text, map_batches, registry, table, texts_of
from .pretokens import CACHE, Recent, of_worker

QUERIES, SQL, query = registry()

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Pairs of tokens that a worker remembers.
PAIRS = 1_000_000


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def read_model(path: str) -> dict:
    return parse_model(model_bytes(path))


def parse_model(content: bytes) -> dict:
    """What encoding needs of a model file; only merge models with byte fallback and no normalisation are taken."""
    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(content)
    norm, train = model.normalizer_spec, model.trainer_spec
    if train.model_type != 2 or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only merge models with byte fallback, a space put before the text and no normalisation")
    if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces) or any(SPACE in p.piece.lstrip(SPACE) for p in model.pieces):
        raise ValueError("pieces with a space mark inside, or of the user, are not supported")
    return {"pieces": [(p.piece, p.score, p.type) for p in model.pieces], "begin": train.bos_id, "end": train.eos_id}


class Codec:
    def __init__(self, model: dict, cache=CACHE, pairs=PAIRS):
        pieces = model["pieces"]
        self.begin, self.end, self.pair_limit = model["begin"], model["end"], pairs
        self.rank, self.id, self.byte_id, self.spaces = {}, {}, {}, {}
        self.piece_bytes = []
        for i, (piece, score, kind) in enumerate(pieces):
            self.piece_bytes.append(b"" if kind == CONTROL else bytes([int(piece[3:5], 16)]) if kind == BYTE else
                                    b" \xe2\x81\x87 " if kind == UNKNOWN else piece.replace(SPACE, " ").encode())
            if kind == BYTE:
                self.byte_id[int(piece[3:5], 16)] = i
            elif kind == NORMAL and not piece.strip(SPACE):
                self.spaces[len(piece)] = i
            if kind == NORMAL:
                self.id[piece] = i
                if piece.strip(SPACE) or piece == SPACE:
                    self.rank[piece] = score
        if any(p.startswith(SPACE * 2) for p in self.rank):
            raise ValueError("pieces of several spaces and a word are not supported")
        self.automaton = ahocorasick.Automaton()
        for piece in self.rank:
            if self.merged(piece) == [piece]:
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.characters = frozenset(p for p in self.rank if len(p) == 1)
        self.marked = {i for p, i in self.id.items() if p.startswith(SPACE)}
        self.apart, self.words = {}, Recent(cache, self.both)
        self.one = {p: int(i).to_bytes(4, "little") for p, i in self.id.items()}
        self.byte_one = [int(self.byte_id[b]).to_bytes(4, "little") for b in range(256)]

    def merged(self, text: str) -> list:
        """The definition: merge the best pair, the leftmost of equals, until none is a piece. For short texts."""
        symbols = list(text)
        while len(symbols) > 1:
            scores = [self.rank.get(a + b, -np.inf) for a, b in zip(symbols, symbols[1:])]
            best = max(scores)
            if best == -np.inf:
                break
            i = scores.index(best)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def compatible(self, left: str, right: str) -> bool:
        """Whether two tokens stay as they are side by side."""
        found = self.apart.get((left, right))
        if found is None:
            found = self.merged(left + right) == [left, right]
            if len(self.apart) >= self.pair_limit:
                self.apart.clear()
            self.apart[left, right] = found
        return found

    def known(self, word: str) -> list:
        """Tokens of a text whose characters are all pieces: the prefix table forwards, then the tokens backwards."""
        last, apart = [""] * (len(word) + 1), self.apart
        for at, piece in self.automaton.iter(word):
            at += 1
            if not last[at]:
                start = at - len(piece)
                if not start:
                    last[at] = piece
                elif before := last[start]:
                    fits = apart.get((before, piece))
                    if fits is None:
                        fits = self.compatible(before, piece)
                    if fits:
                        last[at] = piece
        tokens, at = [], len(word)
        while at:
            tokens.append(last[at])
            at -= len(last[at])
        tokens.reverse()
        return tokens

    def run(self, n: int) -> list:
        """Tokens of n spaces that no word takes: the pieces grow from the left and end at the first length that is missing."""
        tokens = []
        for _ in range(n):
            tokens.append(1)
            while len(tokens) > 1:
                # Equal scores merge leftmost first, so a run is settled from its left end.
                i = next((i for i in range(len(tokens) - 1) if tokens[i] + tokens[i + 1] in self.spaces), None)
                if i is None:
                    break
                tokens[i:i + 2] = [tokens[i] + tokens[i + 1]]
        return tokens

    def chunk(self, chunk: str) -> bytes:
        """Ids of spaces and the word after them."""
        word = chunk.lstrip(SPACE)
        n = len(chunk) - len(word)
        tokens, at = [], 0
        text = (SPACE + word) if n else word
        if self.characters.issuperset(text):
            tokens, at = self.known(text), len(text)
        while at < len(text):
            end = at
            while end < len(text) and text[end] in self.rank:
                end += 1
            if end > at:
                tokens += self.known(text[at:end])
            if end < len(text):
                tokens.append(text[end])
                end += 1
            at = end
        if n and tokens[0] == SPACE:
            tokens = tokens[1:]
        elif n:
            n -= 1
        out = [self.one[SPACE * k] for k in self.space_run(n)] if n else []
        for t in tokens:
            out.append(self.one[t] if t in self.one else b"".join(self.byte_one[b] for b in t.encode()))
        return b"".join(out)

    def space_run(self, n: int) -> list:
        """Long runs repeat the longest piece; what is left over behaves as a short run."""
        longest = max(self.spaces)
        return [longest] * (n // longest) + self.run(n % longest)

    def both(self, chunk: str):
        """Ids of spaces and the word after them, and the bytes that those ids decode to."""
        ids = self.chunk(chunk)
        return ids, self.bytes_of(ids)

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join(map(self.piece_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def chunks(self, text: str) -> list:
        """(ids, decoded bytes) of a text's chunks; short ones are remembered."""
        words, both = self.words, self.both
        return [words[c] if len(c) <= LONGEST else both(c) for c in CHUNK.findall(SPACE + text.replace(" ", SPACE))] if text else []

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian 32-bit, with begin and end."""
        return self.framed(self.chunks(text))

    def framed(self, chunks) -> bytes:
        ends = (int(i).to_bytes(4, "little") for i in (self.begin, self.end))
        return b"".join([ids for ids, _ in chunks]).join(ends)

    def text_of(self, raw: bytes, marked: bool) -> bytes:
        """What bytes of pieces mean: without the space of the first piece, if that has a mark, and U+FFFD for each byte that is no UTF-8."""
        raw = raw[1:] if marked else raw
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "byte").encode()
        return raw

    def decode(self, ids: bytes) -> str:
        """The text of ids; ids that the vocabulary does not have are left out."""
        found = np.frombuffer(ids[:len(ids) // 4 * 4], "<u4")
        found = [i for i in found[found < len(self.piece_bytes)].tolist() if self.piece_bytes[i]]
        return self.text_of(b"".join(map(self.piece_bytes.__getitem__, found)), bool(found) and found[0] in self.marked).decode()

    def round_trip(self, text: str):
        """The ids of a text and, in UTF-8, the text that they decode to: each chunk's ids were decoded when they were first met."""
        chunks = self.chunks(text)
        return self.framed(chunks), self.text_of(b"".join([raw for _, raw in chunks]), bool(chunks))  # (the first chunk has a mark)


def _by_byte(error):
    """One U+FFFD for the first byte that cannot be read; reading goes on behind it."""
    return "�", error.start + 1


codecs.register_error("byte", _by_byte)
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


#: Characters of the longest chunk that is remembered.
LONGEST = 64


def _codec(sent, path):
    return of_worker(("codec", path), lambda: Codec(sent.value))


def encode_texts(df: DataFrame, model: str, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row: the id, `n_tokens` and `ids` (little-endian unsigned 32-bit) with begin and end."""
    sent = df.sparkSession.sparkContext.broadcast(read_model(model))

    def step(batch):
        codec = _codec(sent, model)
        ids = [codec.encode(t) for t in texts_of(batch)]
        return {"doc_id": batch.column("doc_id"), "n_tokens": [len(i) // 4 for i in ids], "ids": ids}
    return map_batches(id_and_text(df, id_col, text_col), step, "doc_id long, n_tokens long, ids binary")


def decode_ids(df: DataFrame, model: str, id_col="doc_id", ids_col="ids") -> DataFrame:
    """One row per row: the id, `ids` as they came, and the decoded `text`; null ids decode to the empty text."""
    sent = df.sparkSession.sparkContext.broadcast(read_model(model))

    def step(batch):
        codec = _codec(sent, model)
        return {"doc_id": batch.column("doc_id"), "ids": batch.column("ids"),
                "text": [codec.decode(i or b"") for i in texts_of(batch, "ids")]}
    return map_batches(df.select(df[id_col].cast("long").alias("doc_id"), df[ids_col].alias("ids")), step, "doc_id long, ids binary, text string")


def codec_digests(df: DataFrame, model: str, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per row, in one pass: the id, the number of ids, and SHA-256 of the ids and of the text that they decode to."""
    sent = df.sparkSession.sparkContext.broadcast(read_model(model))
    digest = lambda raw: hashlib.sha256(raw).hexdigest()

    def step(batch):
        codec = _codec(sent, model)
        found = [codec.round_trip(t) for t in texts_of(batch)]
        return {"doc_id": batch.column("doc_id"), "n_tokens": [len(ids) // 4 for ids, _ in found],
                "ids_sha256": [digest(ids) for ids, _ in found], "decoded_sha256": [digest(raw) for _, raw in found]}
    return map_batches(id_and_text(df, id_col, text_col), step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


@query()
def op8_piece_codec(spark, sf_dir):
    """Ids of all documents and what they decode to, as digests."""
    return codec_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
