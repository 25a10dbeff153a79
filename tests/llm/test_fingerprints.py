"""Merkle fingerprints and toxicity against brute force and held-out labels; the whole pipeline."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from courtledger.llm import fingerprints, packing, pii, toxicity
from tests.llm.test_groups import UPPER, brute_components

LETTERS = str.maketrans("0123456789", "klmnopqrst")
PAIRS = [(3, "one two three four five six\nseven eight\n\nnine ten eleven twelve"), (10, None), (7, ""), (8, "é" * 5), (2, "short"), (12, "w " * 30_000), (1, "日本 語\r\nx"), (15, "short")]


def brute(pairs):
    ordered = sorted(pairs, key=lambda p: (p[0], p[1] or ""), reverse=True)
    for k, (i, t) in enumerate(ordered):
        t, n = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        third = len(t) // 3
        yield i, len(t), hashlib.sha256((t[:len(t) - third] + n[:third]).encode()).hexdigest()


@pytest.mark.parametrize("rows", [3, 1024])
def test_edited_texts(spark, written, real, monkeypatch, rows):
    monkeypatch.setattr(fingerprints, "ROWS", rows)
    pairs = PAIRS + [(i * 7 + 100, t) for i, t in real]
    df = fingerprints.op9_merkle_fingerprints(spark, written(pairs))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = df.collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(brute(pairs))
    texts, of_text = dict(pairs), {}
    for r in got:
        assert of_text.setdefault(texts[r.doc_id] or "", r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(set(of_text.values())) == len(of_text)
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) >= 0.95 * len(long)


def test_odd_tables(spark, written):
    assert fingerprints.op9_merkle_fingerprints(spark, written([])).collect() == []
    alone = fingerprints.op9_merkle_fingerprints(spark, written([(5, "abc def ghi")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0 and alone[0].edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest()
    assert len(fingerprints.op9_merkle_fingerprints(spark, written([(5, "a"), (5, "b"), (5, "a"), (None, "c"), (None, None)])).collect()) == 5


def test_tree_locates_edits(docs_of):
    lines = [f"paragraph {k} has a few words of its own" for k in range(60)]
    changed = list(lines)
    changed[30] += " and more"
    from pyspark.sql import functions as F
    df = docs_of([(1, "\n".join(lines))]).select("doc_id", "text").withColumn("new", F.lit("\n".join(changed)))
    for text, name in (("text", "a"), ("new", "b")):
        df = fingerprints.with_fingerprint(df, text, name)
    row = df.select(fingerprints.differing_sections("a", "b").alias("d"), fingerprints.likeness("a", "b").alias("l"), F.size("a_sections").alias("n")).first()
    assert 1 <= len(row.d) <= 2 and row.n > 8 and 0.9 < row.l < 1


def test_likeness_after_a_shift(spark):
    """Words put in or taken out at the start of a line cost the runs around them, not all that follow on the line."""
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(10_000)}" for _ in range(400)]
    line, unspaced = " ".join(words), "".join(chr(0x4E00 + rnd.randrange(3000)) for _ in range(2000))
    near = [(line, "new " + line), (line, " ".join(words[1:])), (line, " ".join([*words[:5], "some", "more", *words[6:]])),
            (unspaced, "新" + unspaced), (unspaced, unspaced[:700] + unspaced[701:])]
    far = [(line, " ".join(rnd.sample(words, 400))), ("", "a"), (" a", "a"), ("a  ", "a"), (" ", "")]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(near + far)], "doc_id long, text string, new string")
    for text, name in (("text", "a"), ("new", "b")):
        df = fingerprints.with_fingerprint(df, text, name)
    got = {r.doc_id: r for r in df.select("doc_id", fingerprints.likeness("a", "b").alias("l"), "a_root", "b_root").collect()}
    assert all(0.9 < got[k].l < 1 for k in range(len(near)))
    assert got[len(near)].l < 0.5 and all(r.a_root != r.b_root for r in got.values())


def toxic_texts(n=1200, seed=0):
    rnd = random.Random(seed)
    words, bad = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"], ["vilest", "scumbag", "rotten"]
    for i in range(n):
        toxic = rnd.random() < 0.15
        text = [rnd.choice(words) for _ in range(rnd.randint(20, 120))]
        for _ in range(max(2, len(text) // 25) if toxic else 0):
            text[rnd.randrange(len(text))] = rnd.choice(bad)
        yield i, " ".join(text), int(toxic)


def test_toxicity(spark, written):
    rows = list(toxic_texts())
    labels = [(i, 1, y) for i, _, y in rows if i % 10 < 8] + [(3, 1, None), (None, 1, 1), (5000, 1, 1)] + [(i, 0, y) for i, _, y in rows[:50]]
    pairs = [(i, t) for i, t, _ in rows] + [(9001, None), (9002, ""), (9003, "x" * 50_000), (0, rows[0][1])]
    path = written(pairs, labels)
    got = toxicity.op10_toxicity(spark, path).collect()
    assert len(got) == len(pairs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = {i: y for i, _, y in rows}
    held = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([p == y for p, y in held]) > 0.95
    again = toxicity.op10_toxicity(spark, path).collect()
    assert sorted((r.doc_id, r.score) for r in again) == sorted((r.doc_id, r.score) for r in got)
    # Held-out labels are not looked at.
    flipped = written(pairs, [(i, q, 1 - y if y is not None and zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, q, y in labels])
    assert sorted((r.doc_id, r.score) for r in toxicity.op10_toxicity(spark, flipped).collect()) == sorted((r.doc_id, r.score) for r in got)


def test_sample_reaches_the_driver_packed(spark, written, monkeypatch):
    rnd = random.Random(11)
    pairs = [(i, " ".join(f"{rnd.choice('abcdefgh')}word{rnd.randrange(4000)}".translate(LETTERS) for _ in range(rnd.randrange(600)))) for i in range(240)]
    labels = {i: int(i % 4 == 0) for i, _ in pairs}
    path = written(pairs, [(i, 1, y) for i, y in labels.items()])
    rows = {i: toxicity.counted(t, {}) for i, t in pairs if zlib.crc32(str(i).encode()) % 5}
    collected, kind = [], type(spark.range(0))
    monkeypatch.setattr(kind, "toArrow", lambda df, collect=kind.toArrow: collected.append(collect(df)) or collected[-1])
    weights, bias = toxicity.fit(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    found = sum(len(ids) for ids, _, _ in rows.values())
    assert found > 100_000 and sum(t.num_rows for t in collected) == len(rows)
    assert sum(t.nbytes for t in collected) < 4 * found
    # The model is that of the rows as they were counted.
    plain = toxicity.train([rows[i] for i in sorted(rows)], [labels[i] for i in sorted(rows)])
    assert np.array_equal(weights, plain[0]) and weights.any() and bias == plain[1]


@pytest.mark.parametrize("text", ["", "one", "a b " * 70_000, " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}xyz" for k in range(600))])
def test_packed_rows(text):
    ids, counts, _ = toxicity.counted(text, {})
    again = toxicity.unpacked(toxicity.packed(ids, counts))
    assert [a.dtype for a in again] == [ids.dtype, counts.dtype] and np.array_equal(again[0], ids) and np.array_equal(again[1], counts)


def test_toxicity_of_odd_tables(spark, written):
    assert toxicity.op10_toxicity(spark, written([])).collect() == []
    assert {r.score for r in toxicity.op10_toxicity(spark, written([(1, "a"), (2, None)])).collect()} == {0.0}
    assert {r.score for r in toxicity.op10_toxicity(spark, written([(1, "a"), (2, None)], [(1, 1, 0), (2, 1, 0)])).collect()} == {0.0}


def test_non_negative_step():
    """Where positives outweigh the unlabelled risk, the step goes back instead of on."""
    p, u = toxicity.pu_gradient(np.array([3.0, 3.0]), np.array([-4.0, -4.0]), 0.3)
    assert (p > 0).all() and (u < 0).all()
    p, u = toxicity.pu_gradient(np.array([0.0]), np.array([0.0]), 0.3)
    assert (p < 0).all() and (u > 0).all()


def test_pipeline(spark, written):
    rows = list(toxic_texts(400, seed=4))
    rnd = random.Random(8)
    long = " ".join(f"t{rnd.randrange(5000)}" for _ in range(300))
    pairs = [(i, t) for i, t, _ in rows] + [(500, long), (501, long + " tail"), (502, long.upper()), (503, "mail me a@b.cd please"), (504, None), (505, ""), (500, long)]
    path = written(pairs, [(i, 1, y) for i, _, y in rows])
    got = corpus_pipeline.run(spark, path).collect()
    df = spark.read.parquet(f"{path}/documents.parquet")
    columns = df.columns
    left, docs = dict(pairs), df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, path)
        assert docs.columns == columns, name
        found = docs.collect()
        now = {r.doc_id: r.text for r in found}
        assert len(now) == len(found) or name == "toxicity"
        if name == "toxicity":
            scores = {r.doc_id: r.score for r in toxicity.op10_toxicity(spark, path).collect()}
            assert set(now) == {i for i in left if scores[i] < 0.5} and len(left) > len(now) > 300
        if name == "exact_dedup":
            best = {}
            for i, t in left.items():
                key = (t or "").translate(UPPER)
                best[key] = max(best.get(key, -1), i)
            assert set(now) == set(best.values())
        if name == "near_dedup":
            assert set(now) == {i for i, (_, c) in brute_components(left.items(), 5, 80).items() if c == i} and len(now) < len(left)
        if name == "pii":
            assert now == {i: t and pii.redact(t, sum(pii.find_in(t), [])) for i, t in left.items()} and now[503] == "mail me [EMAIL] please"
        left = now
    assert {r.doc_id for r in got} == set(left)
    want = packing.pack_documents(docs, corpus_pipeline.public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in got) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in want)
