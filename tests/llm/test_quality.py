"""Features and the cascade of the quality rules against plain Python."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from courtledger.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "a b c a b c"), (6, "a a a a"), (7, "a\na\n a\n\na"), (8, "x " * 60), (9, "#$%& |<>*"),
    (10, "é ß 東京 👩‍👩‍👧 a b \x1c x"), (11, "\r\n".join(["same line here"] * 30)), (12, "word" * 20_000), (13, "THERTI!! WAS!! " * 40), (None, "no id " * 40),
    (14, " ".join(f"w{i}" for i in range(5000)) + " w1 w2 w3"), (14, "again"), (14, "again"), (15, "- point one\n" * 60), (16, "It was so...\nAnd then…\n" * 40),
    (17, "a b c d\x0be f\x0cg a b c"), (18, "| 12 | 34 |\n" * 30),
]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, chars, symbols, dups, repeats = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)
    base_failed = n < 50 or 100 * repeats > 50 * n
    bad = (chars < 3 * n or chars > 10 * n or 100 * symbols > 10 * n or 100 * dups > 30 * len(lines)
           or 100 * sum(not any(c.isalpha() for c in w) for w in words) > 20 * n or 100 * len(re.findall("[A-Z]", text)) > 40 * chars
           or 100 * text.count("!") > 20 * n or 100 * sum(x.rstrip(" ").endswith(("...", "…")) for x in lines) > 30 * len(lines)
           or 100 * sum(x.strip(" \t\n\x0b\f\r")[:2] in ("- ", "* ", "• ") for x in lines) > 90 * len(lines))
    return n, chars, symbols, dups, repeats, base_failed, not base_failed and not bad


@pytest.fixture(scope="module")
def judged(spark, written, real):
    pairs = ODD + [(i + 100, t) for i, t in real]
    return pairs, qr.op12_quality_rules(spark, written(pairs))


def test_like_plain_python(judged):
    pairs, df = judged
    assert df.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted((tuple(r) for r in df.collect()), key=str) == sorted(((i, *plain(t)) for i, t in pairs), key=str)


def test_no_python_in_the_plan(judged):
    plan = judged[1]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_no_rows(spark, written, docs_of):
    assert qr.op12_quality_rules(spark, written([])).collect() == []
    assert qr.with_verdict(docs_of([])).collect() == []


def test_order_by_rejections_per_second():
    """The best rule first, each judged by what the rules before it leave; the first of equals."""
    patterns = {frozenset(): 50, frozenset("ab"): 30, frozenset("b"): 10, frozenset("c"): 5, frozenset("ac"): 5}
    order = qr.ordered(patterns, {"a": 1.0, "b": 2.0, "c": 0.1})
    assert [(e.name, e.rejected) for e in order] == [("c", 10), ("a", 30), ("b", 10)]
    assert [e.name for e in qr.ordered({frozenset("b"): 3}, {"a": 1.0, "b": 9.0, "c": 1.0})] == ["b", "a", "c"]
    assert [e.name for e in qr.ordered({}, {"a": 1.0, "b": 2.0})] == ["a", "b"]


def test_verdicts_do_not_depend_on_the_order(docs_of, real):
    df = docs_of(ODD + [(i + 100, t) for i, t in real])
    text = F.coalesce("text", F.lit(""))
    verdict = lambda order: [r[0] for r in df.select(qr.cascade(order, qr.RULES, text).isNull()).collect()]
    names = list(qr.RULES)
    assert verdict(names) == verdict(names[::-1]) == verdict(names[3:] + names[:3])


def test_later_rules_are_not_asked(docs_of):
    """A rule that would fail the job is behind one that rejects."""
    df = docs_of([(1, "a"), (2, "b")])
    rules = {"all": lambda of: of("n_words") < 50, "broken": lambda of: F.raise_error(F.lit("asked")).cast("boolean")}
    assert [r[0] for r in df.select(qr.cascade(["all", "broken"], rules, F.col("text"))).collect()] == ["all", "all"]
    with pytest.raises(Exception, match="asked"):
        df.select(qr.cascade(["broken", "all"], rules, F.col("text"))).collect()


def test_estimate_and_rows_kept(docs_of, real):
    df = docs_of(ODD + [(i + 100, t) for i, t in real])
    found = qr.estimate(df, qr.RULES, size=60)
    assert {e.name for e in found} == set(qr.RULES) and all(e.seconds > 0 for e in found)
    kept = qr.keep_good(df)
    assert kept.columns == df.columns
    want = [i if k < len(ODD) else i + 100 for k, (i, t) in enumerate(ODD + real) if plain(t)[6]]
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(want)
    verdicts = qr.with_verdict(df)
    assert verdicts.where("rejected_by IS NULL").count() == len(want) and verdicts.columns == [*df.columns, "rejected_by"]
