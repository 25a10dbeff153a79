"""Splitting a text into the units that a byte-pair tokenizer encodes one by one, and per-worker caches of their ids.

A tokenizer of the `tokenizers` library first splits a text at its special strings and by a pattern; each piece is then
encoded on its own. So a text's ids are those of its pieces, and a piece has to be encoded once per worker only. Texts
with characters that this Python's Unicode tables do not know are encoded whole by the library, since a newer table
might split them elsewhere.
"""

import json
import re
import unicodedata

import regex
from tokenizers import Tokenizer

#: Pieces that a worker remembers; beyond it, it starts again from the shared table.
CACHE = 400_000
_workers = {}


def unassigned(text: str) -> bool:
    return not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text) if c > "˿")


def byte_letters() -> dict:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + k) for k, b in enumerate(others)}


class Splitter:
    """`pieces(text)`: normalised pieces of a text, and the ids of the special strings between them."""

    def __init__(self, spec: str):
        config = json.loads(spec)
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges, self.letters = self.tokenizer.model, byte_letters()
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in config["added_tokens"]):
            raise ValueError("special strings that take part of their surroundings are not supported")
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.lower = config["normalizer"] is not None
        steps = [s["type"] for s in (config["normalizer"] or {}).get("normalizers", [])]
        if self.lower and steps != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"normalizers {steps} are not supported")
        split = config["pre_tokenizer"]
        if split["type"] == "Sequence":
            pattern = split["pretokenizers"][0]["pattern"]["Regex"]
        elif split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]:
            from public_tokenizers import PATTERN as pattern
        else:
            raise ValueError(f"pre-tokenizer {split['type']} is not supported")
        self.find = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\p{White_Space}\p{L}\p{N}]").replace(r"\s", r"\p{White_Space}")
                                  .replace(r"\S", r"\P{White_Space}")).findall
        #: Whether white space stands between pieces and in none of them.
        self.drops_space = split["type"] == "Sequence" and not any(map(str.isspace, "".join(self.find(" a 1\t.\n'\xa0b  "))))

    def parts(self, text: str):
        """The text between special strings, each special string alone."""
        return self.cut.split(text) if self.cut and "<|" in text else (text,)

    def normalised(self, part: str) -> str:
        if self.lower:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            part = part.lower()
        return part

    def pieces(self, part: str):
        return self.find(self.normalised(part))

    def encode_piece(self, piece: str):
        """Ids of one piece, straight from the merges: neither special strings nor the normaliser can touch it any more."""
        if piece.isascii() and piece.isprintable():  # of these bytes only the space has another letter than itself
            letters = piece.replace(" ", self.letters[0x20])
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.merges.tokenize(letters)]

    def encode(self, text: str):
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Cache(dict):
    """Piece to `value(ids)`. Hits cost a look-up; misses are encoded and remembered, up to a bound."""

    def __init__(self, splitter, value, shared=(), limit=CACHE):
        super().__init__(shared)
        self.splitter, self.value, self.shared, self.limit = splitter, value, shared, limit

    def __missing__(self, piece):
        found = self.value(self.splitter.encode_piece(piece))
        if len(self) >= self.limit:
            self.clear()
            self.update(self.shared)
        self[piece] = found
        return found


class Recent(dict):
    """Remembers what was asked for lately: when it is full, what was not asked for since it was last full is forgotten."""

    def __init__(self, limit, make=None):
        super().__init__()
        self.limit, self.before, self.make = limit, {}, make

    def recall(self, key):
        """What is known of a key that is not among the newest."""
        found = self.before.get(key)
        if found is not None:
            self.learn(key, found)
        return found

    def learn(self, key, value):
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value

    def __missing__(self, key):
        found = self.recall(key)
        if found is None:
            found = self.make(key)
            self.learn(key, found)
        return found


def of_worker(key, make):
    """One object per key and Python worker, for as long as Spark keeps the worker."""
    if key not in _workers:
        _workers.clear()
        _workers[key] = make()
    return _workers[key]
