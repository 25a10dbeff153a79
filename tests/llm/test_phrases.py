"""Collocations against plain counting with whole numbers of any size."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from courtledger.llm import phrases

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, support=10, share=50, top=2000):
    """`docs` are (lang, text)."""
    n, f = Counter(), Counter()
    for lang, text in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i:i + k])) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    found = []
    for (lang, words), a in f.items():
        if len(words) == 1 or a < support:
            continue
        # A longer candidate has this phrase before or behind one more word.
        if len(words) == 2 and any(100 * b >= share * a and b >= support for (m, long), b in f.items()
                                   if m == lang and len(long) == 3 and words in (long[:2], long[1:])):
            continue
        score, _, le, r = min((1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words)))
        found.append((lang, -score, -a, " ".join(words).encode(), le, r))
    out = []
    for lang in {x[0] for x in found}:
        ranked = sorted(x for x in found if x[0] == lang)[:top]
        out += [(lang, k, p.decode(), -a, le, r, n[lang], -score) for k, (_, score, a, p, le, r) in enumerate(ranked, 1)]
    return sorted(out)


def rows_of(docs_of, docs):
    df = docs_of([(i % 50 if i % 7 else None, text) for i, (_, text) in enumerate(docs)], parts=5)
    langs = df.sparkSession.createDataFrame([(text, lang) for lang, text in docs], "text string, l string")
    return langs.withColumnRenamed("l", "lang") if docs else df.select("text", "lang")


def with_ids(df):
    return df.selectExpr("*", "CAST(NULL AS LONG) AS doc_id", "'x' AS key", "1 AS slot", "'y' AS phrase", "2 AS shard")


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    words = ["the", "of", "New", "york", "city", "a", "x1", "é", "ß-z", "�", "東京", "don't"] + [f"w{i}" for i in range(60)]
    texts = []
    for i in range(300):
        parts = rng.choices(words, k=rng.randrange(0, 40)) + ["New", "York", "City"] * (i % 3)
        texts.append((rng.choice(["en", "en", "en", "fr", None, "und"]),
                      "".join(w + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "\r\n", " \x0b", ";", "! "]) for w in parts)))
    texts += [("en", "again and again " * 30)] * 5 + [("en", None), ("fr", ""), (None, " \t\n"), ("de", "one"), ("de", "one two"), ("hot", "a a a a " * 200)]
    return texts


def result(df, **options):
    return sorted(tuple(r) for r in phrases.collocations(with_ids(df), **options).collect())


def test_like_plain_counting(docs_of, corpus):
    df = rows_of(docs_of, corpus)
    want = plain(corpus)
    assert result(df.repartition(7)) == want and len(want) > 10
    assert result(df, support=3, top=7) == plain(corpus, support=3, top=7)
    assert phrases.collocations(with_ids(df)).dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"),
                                                         ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]


def test_no_words(docs_of):
    assert result(rows_of(docs_of, [])) == [] == result(rows_of(docs_of, [("en", None), ("en", "")]))


def gathered(texts, size, hashes=None):
    """Words and pairs of neighbours by the blocks of some texts."""
    words, pairs = [], []
    for block in phrases.blocks(texts, size):
        found = [block.word(i) for i in range(len(block.start))]
        words += [(o, w) for o, w in zip(block.owner.tolist(), found)]
        pairs += [(found[i], found[i + 1]) for i in np.flatnonzero(block.follows)]
    return words, pairs


@pytest.mark.parametrize("size", [1, 5, 64, 1 << 20])
def test_blocks(corpus, size):
    texts = [(t or "").encode() for _, t in corpus[:80]]
    want_words, want_pairs = [], []
    for o, t in enumerate(texts):
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", t.lower()):
            found = re.findall(rb"[^\x20\x09]+", piece)
            want_words += [(o, w) for w in found]
            want_pairs += list(zip(found, found[1:]))
    assert gathered(texts, size) == (want_words, want_pairs)


def test_hashes_depend_on_the_bytes_alone(corpus):
    block = phrases.Block([(t or "").encode() for _, t in corpus], range(len(corpus)))
    for which in (0, 1):
        of_word = {}
        for i, h in enumerate(block.hashes(which).tolist()):
            assert of_word.setdefault(block.word(i), h) == h
        assert len(set(of_word.values())) == len(of_word)


def test_equal_hashes_of_different_words(corpus):
    """Words whose hashes collide are told apart by their bytes."""
    block = phrases.Block([(t or "").encode() for _, t in corpus[:50]], range(50))
    langs, same = np.zeros(len(block.start), np.int64), np.zeros(len(block.start), np.uint64)
    known = phrases.Words()
    numbers = known.number(block, langs, same, block.hashes(1))
    back = {i: w for (_, w), i in known.items()}
    assert [back[i] for i in numbers.tolist()] == [block.word(i) for i in range(len(numbers))]


def test_few_known_words_and_small_blocks(monkeypatch, corpus):
    """The counts of a task do not depend on when it adds up: run the last pass's function on its own with tiny bounds."""
    import pyarrow as pa
    few = corpus[:60]
    batch = pa.RecordBatch.from_pydict({"raw": [(t or "").encode() for _, t in few], "lang": [lang or "und" for lang, _ in few], "slot": np.zeros(len(few), np.int32),
                                        "shard": np.zeros(len(few), np.int32)})
    everything = [np.full(1 << 12, 255, np.uint8)] * 3

    class Rows:
        """Stands for a frame: keeps the function that it is given."""
        class sparkSession:
            class sparkContext:
                broadcast = staticmethod(lambda value: type("Sent", (), {"value": value}))

        def mapInArrow(self, run, schema):
            self.run = run
            raise StopIteration

    counts = []
    for bounds in ({}, {"GATHER": 50, "KNOWN": 40, "BLOCK": 30}):
        for name, value in bounds.items():
            monkeypatch.setattr(phrases, name, value)
        monkeypatch.setattr(phrases, "bounded_batches", lambda spark: None)
        rows = Rows()
        with pytest.raises(StopIteration):
            phrases.count_candidates(rows, everything, 1)
        found = Counter()
        for out in rows.run(iter([batch, batch])):
            for r in out.to_pylist():
                found[r["lang"], r["phrase"], r["n_words"]] += r["f"]
        counts.append(found)
    assert counts[0] == counts[1] and counts[0]["und", "the", 1] > 0


def test_scores_beyond_64_bits(spark):
    """Counts whose products pass 64 bits, and ties of cuts."""
    big = 3_000_000_000_017
    table = [("en", "a", 1, big), ("en", "b", 1, big + 5), ("en", "a b", 2, big - 1), ("en", "c", 1, 10), ("en", "b c", 2, 10), ("en", "a b c", 3, 10)]
    got = {r.phrase: (r.l, r.r, r.score) for r in phrases.scored(spark.createDataFrame(table, "lang string, phrase string, n_words int, f long"), 50, 3).collect()}
    f = {p: n for _, p, _, n in table}
    a = big - 1
    assert got == {"a b": (big, big + 5, 10 ** 6 * a * a // (big * (big + 5))),
                   "a b c": min(((f["a"], f["b c"], 10 ** 8 // (f["a"] * f["b c"])), (f["a b"], f["c"], 10 ** 8 // (f["a b"] * f["c"]))), key=lambda x: x[2])}
