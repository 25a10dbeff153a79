"""Exact and near duplicates, archives and the filter, against brute force."""

import base64
import gc
import gzip
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from courtledger.llm import dedup, fuse, near_dedup, pretokens, warc

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 100, 5000])
def test_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    built = fuse.build(np.concatenate([keys, keys]))
    assert fuse.maybe(keys, *built).all()
    assert fuse.maybe(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64), *built).mean() < 0.02
    assert len(built[3]) < 1.4 * n + 64


PAIRS = [(1, "Same text"), (2, "sAME TEXT"), (9, "same text"), (4, "same  text"), (5, None), (6, ""), (7, "É"), (8, "é"), (10, "x" * 60_000), (11, "X" * 60_000), (None, "same text"), (None, "alone")]


def test_exact(spark, written, real, docs_of):
    pairs = PAIRS + [(i + 100, t) for i, t in real] + [(i + 1000, t) for i, t in real[:20]] + [(1, "Same text")]
    got = dedup.op2_exact_dedup(spark, written(pairs)).collect()
    groups = defaultdict(list)
    for i, t in pairs:
        groups[(t or "").translate(UPPER)].append(i)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), keep is None or i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    clean = lambda rows: sorted(map(str, rows))
    assert clean((r.doc_id, r.keep_id, r.group_size, bool(r.kept), r.text_sha256) for r in got) == clean(want)
    assert dedup.op2_exact_dedup(spark, written([])).collect() == []
    alone = dedup.dedup(docs_of(pairs)).collect()
    assert clean((r.doc_id, r.keep_id) for r in alone) == clean((r.doc_id, r.keep_id) for r in got)


def test_batch_against_snapshot(docs_of):
    old, new = docs_of([(1, "a b"), (5, "only old"), (2, "A B")]), docs_of([(3, "A b"), (0, "only new"), (4, "Only New")])
    got = {r.doc_id: (r.keep_id, r.group_size) for r in dedup.dedup(new, old).collect()}
    assert got == {1: (3, 3), 2: (3, 3), 3: (3, 3), 5: (5, 1), 0: (4, 2), 4: (4, 2)}
    empty = docs_of([])
    assert {r.doc_id: r.keep_id for r in dedup.dedup(new, empty).collect()} == {3: 3, 0: 4, 4: 4}
    assert {r.doc_id: r.keep_id for r in dedup.dedup(empty, old).collect()} == {1: 2, 2: 2, 5: 5}


def test_null_ids_across_batches(docs_of):
    """Rows without an id meet rows of the other half as any others do."""
    got = sorted(map(str, ((r.doc_id, r.keep_id, r.group_size, r.kept) for r in dedup.dedup(docs_of([(None, "q"), (None, "z"), (None, "Z")]), docs_of([(1, "q"), (None, "z"), (2, "y")])).collect())))
    assert got == sorted(map(str, [(None, 1, 2, False), (1, 1, 2, True), (None, None, 3, True), (None, None, 3, True), (None, None, 3, True), (2, 2, 1, True)]))


def test_kept_rows(docs_of):
    df = docs_of([(1, "a"), (2, "A"), (2, "A"), (3, "b"), (None, "c"), (4, None)])
    got = dedup.drop_copies(df)
    assert got.columns == df.columns and sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(2, "A"), (3, "b"), (None, "c"), (4, None)]))


def brute_components(pairs, n_words, percent):
    sets = {}
    for i, t in pairs:
        words = (t or "").encode().translate(bytes(range(256))).lower().split()
        found = {tuple(words[k:k + n_words]) for k in range(len(words) - n_words + 1)} if len(words) >= n_words else ({tuple(words)} if words else set())
        sets[i] = found
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and abs(len(sets[a]) - len(sets[b])) <= 0.25 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_texts():
    """A family of copies with more and more edits, chains, tiny texts and a boundary pair."""
    rnd = random.Random(3)
    words = [f"w{k}" for k in range(3000)]
    base = [rnd.choice(words) for _ in range(200)]
    pairs = [(0, " ".join(base))]
    for i in range(1, 60):
        copy = list(base)
        for _ in range(rnd.randint(0, 12)):
            copy[rnd.randrange(200)] = rnd.choice(words)
        pairs.append((i, " ".join(copy) if i % 3 else " ".join(copy).upper()))
    chain = [rnd.choice(words) for _ in range(150)]
    for i in range(100, 120):
        chain[rnd.randrange(150)] = "z"
        chain[rnd.randrange(150)] = "y"
        pairs.append((i, "\t".join(chain)))
    # 40 and 50 shingles of four words, all of the smaller one shared: 80 in 100.
    line = [f"q{k}" for k in range(53)]
    pairs += [(200, " ".join(line)), (201, " ".join(line[:43])), (202, " ".join(line[:42]))]
    return pairs + [(300, None), (301, ""), (302, " \n "), (303, "one"), (304, "ONE"), (305, "one two"), (306, "é x"), (307, "É x"), (308, "w " * 5000)]


@pytest.mark.parametrize("n_words", [4, 5])
def test_near(docs_of, real, n_words):
    pairs = near_texts() + [(i + 1000, t) for i, t in real]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(docs_of(pairs), n_words).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute_components(pairs, n_words, 80).items()}


def test_near_query_and_odd_rows(spark, written, docs_of):
    pairs = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "a b c d e f"), (3, None)]
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in near_dedup.op5_near_duplicates(spark, written(pairs)).collect())
    assert got == [("1", 3, 1, True), ("1", 3, 1, True), ("2", 3, 1, False), ("3", 0, 3, True), ("None", 3, None, True)]
    assert near_dedup.op5_near_duplicates(spark, written([])).collect() == []
    df = docs_of(pairs)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3", "None"]


def test_open_pairs_of_a_large_bucket(spark, monkeypatch):
    """Vertices of one bucket that their leader does not link are compared in blocks, each pair once."""
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    sketch, parities = [0] * (near_dedup.BITS // 64), [0] * (near_dedup.SET_BITS // 64)
    vertices = spark.createDataFrame([(i, 9, sketch, parities) for i in range(20)], "doc_id long, n_shingles long, sketch array<long>, parities array<long>")
    buckets = spark.createDataFrame([(i, 7, 0, 20) for i in range(20)], "node long, band long, leader long, n long")
    linked = spark.createDataFrame([(i, i // 10 * 10) for i in range(20)], "node long, component long")
    got = [(r.a, r.b) for r in near_dedup.open_pairs(buckets, linked, vertices, 80).collect()]
    assert sorted(got) == [(a, b) for a in range(1, 10) for b in range(10, 20)]


def test_drawn_leaders(spark, monkeypatch):
    """A large bucket whose smallest vertex links few: other leaders tie most of it together before pairs are made, and no link is lost."""
    n, band = 120, list(range(30))
    vertices = spark.createDataFrame([(i, 9, [0] * (near_dedup.BITS // 64), [0] * (near_dedup.SET_BITS // 64)) for i in range(n)],
                                     "doc_id long, n_shingles long, sketch array<long>, parities array<long>")
    buckets = spark.createDataFrame([(i, b, 0, n) for i in range(n) for b in band], "node long, band long, leader long, n long")
    alone = spark.createDataFrame([(i, i) for i in range(n)], "node long, component long")
    # Vertices are linked if their numbers are less than half of all apart: the smallest one is linked with the lower half only.
    confirm = lambda pairs: pairs.where(f"b - a < {n // 2}")
    linked, rows = near_dedup.drawn_leader_links(buckets, alone, confirm)
    left = near_dedup.open_pairs(buckets, linked, vertices, 80, rows).count()
    assert left < near_dedup.open_pairs(buckets, alone, vertices, 80).count() / 4
    assert {r.component for r in near_dedup.merged(linked, confirm(near_dedup.open_pairs(buckets, linked, vertices, 80, rows))).collect()} == {0}
    monkeypatch.setattr(near_dedup, "EASY", 1 << 40)
    assert near_dedup.drawn_leader_links(buckets, alone, confirm)[0] is alone


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(139, 50), (50, 51)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 50 for i in [50, 51, *range(100, 140)]}}


PAGES = [(1, "http://a/ b", "<p>same</p>"), (2, "http://b", "<p>same</p>"), (3, None, None), (4, "http://d", ""), (7, "http://e", "é\r\n\r\nWARC/1.1\n"), (5, "http://f", "x" * 100_000),
         (8, "http://g", "é\r\n\r\nWARC/1.1\n"), (None, "http://n", "no id"), (9, "http://h", "<p>same</p>")]


def test_archives(spark, tmp_path):
    frame = spark.createDataFrame([(*p, "extra", 1) for p in PAGES], "page_id long, url string, html string, record_id string, payload long").repartition(3)
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    got = warc.op6_arc_to_warc(spark, str(tmp_path)).collect()
    best = {}
    for i, _, html in PAGES:
        best[html or ""] = max(best.get(html or "", -1), i if i is not None else -1)
    want = []
    for i, _, html in PAGES:
        raw, top = (html or "").encode(), best[html or ""]
        revisit = top not in (-1, i)
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    spark.createDataFrame([], frame.schema).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert warc.op6_arc_to_warc(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("version", [b"1", b"2"])
def test_arc_versions(version):
    bodies = [b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nhello", b"no header", b"", b"http://fake 1.1.1.1 2020 text/html 3\nabc"]
    file = warc.arc_version_block(version, "f.arc", "20200102030405")
    for b in bodies:
        file += warc.arc_record(version, "http://x/", "1.2.3.4", "20200102030405", "text/html", b, len(file), "f.arc")
    records = list(warc.arc_records(file))
    assert [b for _, b in records] == bodies and all(f["URL"] == "http://x/" and f["Archive-date"] == "20200102030405" for f, _ in records)
    with pytest.raises(ValueError):
        list(warc.arc_records(file[:-20]))


def test_files_hold_standard_records(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    list(warc.convert_archives(warc.arc_files(pages), f"{tmp_path}/w").collect())
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("*.gz")))
    assert raw.count(b"WARC-Type: revisit") == 4 and raw.count(b"WARC-Record-ID: <urn:uuid:") == len(PAGES)


def test_word_hashes_go_with_the_stage():
    kept = lambda: any(isinstance(o, near_dedup.WordHashes) and len(o) for o in gc.get_objects())
    found = near_dedup.shingles("one two three one two three", 2)
    assert len(found) == 3 and kept()
    pretokens.of_worker("another stage", dict)
    assert not kept()
    assert list(near_dedup.shingles("one two three one two three", 2)) == list(found)
