"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a condition under which a text is rejected, made of features of the text. The cascade asks the rules one after the
other and stops at the first that rejects, so their order decides what a row costs. It is found on a sample: each rule's
rejections come from one job that counts the patterns of failing rules, each rule's cost from the time it takes over the
stored sample; then the rule with the most rejections per second goes first, and again among the rows that are left. The
order never changes which rows are rejected, only which rule is named for a row that several reject.

The sample is drawn by a hash from all rows, about `SAMPLE` of them and never more than twice as many; it decides about the
order and nothing else. Rules are asked on whole texts, and every row is asked.

Defined cases: a null or empty text has no words, no lines and no repeats, and so too few words; repeated rows are each
judged alike; null ids and nulls in other columns change nothing; an empty table gives an empty table (the rules then keep the
order in which they are listed); other columns of the frame are kept by `with_verdict` and `keep_good`, but for one named
`rejected_by`, which is replaced; the query takes id and text alone. Ties of the order are broken by the list's order.
Within a row, time grows as n log n with its words.
"""

import time
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import registry, table

QUERIES, SQL, query = registry()

SAMPLE = 1000
#: Words in a window whose repetition counts.
WINDOW = 3
SPACES = " \t\n\x0b\f\r"
NO_LETTER = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])"


def let(value: Column, use) -> Column:
    """`use(value)` with the value worked out once, within one expression: so nothing of it is computed if a cascade stops before."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")


def lines(text: Column) -> Column:
    """The lines that have a word in them."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")


def repeated_words(found: Column, width=WINDOW) -> Column:
    """How many words stand in a window of `width` words that the text has more than once.

    Windows are sorted with their places, so equal ones are neighbours.
    """
    last = F.greatest(F.size(found) - (width - 1), F.lit(0))

    def window(word, at):
        return F.struct(F.concat(word, *[part for k in range(1, width) for part in (F.lit(" "), F.get(found, at + k))]).alias("words"), at.alias("at"))

    def covered(ordered):
        of_pair = lambda a, b: F.when(a["words"] == b["words"], F.array(*[x["at"] + k for x in (a, b) for k in range(width)]))
        places = F.zip_with(ordered, F.slice(ordered, F.lit(2), F.greatest(F.size(ordered), F.lit(1))), of_pair)
        return F.size(F.array_distinct(F.flatten(F.filter(places, lambda p: p.isNotNull()))))
    return let(F.sort_array(F.transform(F.slice(found, F.lit(1), last), window)), covered)


#: Features by name; each is a function of the text's column and of a function that gives another feature.
FEATURES = {
    "words": lambda text, of: words(text),
    "n_words": lambda text, of: F.size(of("words")).cast("long"),
    "word_chars": lambda text, of: F.char_length(F.array_join(of("words"), "")).cast("long"),
    "n_symbols": lambda text, of: count_of(text, r"[#*$%&|<>]"),
    "n_lines": lambda text, of: F.size(lines(text)).cast("long"),
    "n_dup_lines": lambda text, of: let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    "n_repeat_words": lambda text, of: let(of("words"), repeated_words).cast("long"),
    "n_no_letter": lambda text, of: count_of(text, NO_LETTER),
    "n_capitals": lambda text, of: count_of(text, "[A-Z]"),
    "n_exclamations": lambda text, of: count_of(text, "!"),
    "n_ellipsis_lines": lambda text, of: F.size(F.filter(lines(text), lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long"),
    "n_bullet_lines": lambda text, of: F.size(F.filter(lines(text), lambda x: F.substring(F.btrim(x, F.lit(SPACES)), 1, 2).isin("- ", "* ", "• "))).cast("long"),
}
BASE = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: When a text is rejected, by the name of the rule; thresholds in whole percents, so that no rounding decides.
BASE_RULES = {
    "too_few_words": lambda of: of("n_words") < 50,
    "repeated_words": lambda of: of("n_repeat_words") * 100 > of("n_words") * 50,
}
METHOD_RULES = {
    "word_length": lambda of: (of("word_chars") < of("n_words") * 3) | (of("word_chars") > of("n_words") * 10),
    "symbols": lambda of: of("n_symbols") * 100 > of("n_words") * 10,
    "equal_lines": lambda of: of("n_dup_lines") * 100 > of("n_lines") * 30,
    "no_letters": lambda of: of("n_no_letter") * 100 > of("n_words") * 20,
    "capitals": lambda of: of("n_capitals") * 100 > of("word_chars") * 40,
    "exclamations": lambda of: of("n_exclamations") * 100 > of("n_words") * 20,
    "ellipsis_lines": lambda of: of("n_ellipsis_lines") * 100 > of("n_lines") * 30,
    "bullet_lines": lambda of: of("n_bullet_lines") * 100 > of("n_lines") * 90,
}
RULES = {**BASE_RULES, **METHOD_RULES}


def feature_of(text: Column, given=()):
    """A function from a feature's name to its column: the frame's own column if it is among `given`, else an expression of the text."""
    def of(name):
        return F.col(name) if name in given else FEATURES[name](text, of)
    return of


class Estimate(NamedTuple):
    name: str
    seconds: float   # to ask the whole sample
    rejected: int    # rows of the sample that it rejects, of those that the rules before it leave


def _seconds(df: DataFrame, condition: Column) -> float:
    best = None
    for _ in range(2):
        begin = time.perf_counter()
        df.agg(F.count_if(condition)).collect()
        took = time.perf_counter() - begin
        best = took if best is None else min(best, took)
    return best


def ordered(patterns: dict, costs: dict) -> list:
    """Rules by rejections per second, each among the rows that the rules before it leave. `patterns`: rows by set of failing rules."""
    left, rest, found = dict(patterns), list(costs), []
    while rest:
        rejected = {r: sum(n for failing, n in left.items() if r in failing) for r in rest}
        best = max(rest, key=lambda r: rejected[r] / costs[r])  # the first of equals
        found.append(Estimate(best, costs[best], rejected[best]))
        left = {failing: n for failing, n in left.items() if best not in failing}
        rest.remove(best)
    return found


def estimate(df: DataFrame, rules: dict, text_col="text", given=(), size=SAMPLE) -> list:
    """The rules in the order of the cascade, with what was found out on the sample. At most 2 * size rows reach it.

    `given` names features that will be there when the rules are asked, and so cost nothing.
    """
    share = min(1.0, size / max(1, df.count()))
    texts = df.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    drawn = texts.where(F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(1 << 20)) <= int(share * (1 << 20)))
    sample = cut_lineage(with_features(drawn.limit(2 * size), given))
    of = feature_of(F.col("text"), given)
    fails = {name: F.coalesce(rule(of), F.lit(False)) for name, rule in rules.items()}
    # At most as many patterns as the sample has rows.
    rows = sample.groupBy(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in fails.items()])).alias("failing")).count().collect()
    nothing = _seconds(sample, F.col("text").isNull())
    costs = {name: max(_seconds(sample, c) - nothing, 0.001) for name, c in fails.items()}
    return ordered({frozenset(r["failing"]): r["count"] for r in rows}, costs)


def cascade(order, rules: dict, text: Column, given=()) -> Column:
    """The name of the first rule that rejects, null if none does; conditions behind it are not worked out."""
    of, chain = feature_of(text, given), F
    for name in order:
        chain = chain.when(rules[name](of), F.lit(name))
    return chain if chain is not F else F.lit(None).cast("string")


def with_verdict(df: DataFrame, rules: dict = RULES, text_col="text", given=(), size=SAMPLE) -> DataFrame:
    """The rows with `rejected_by`, the name of the rule that rejects them, null if none does. `given` names features that are columns already."""
    order = [e.name for e in estimate(df, rules, text_col, given, size)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.withColumn("rejected_by", cascade(order, rules, text, given))


def keep_good(df: DataFrame, rules: dict = RULES, text_col="text", size=SAMPLE) -> DataFrame:
    """The rows that no rule rejects, with their columns."""
    order = [e.name for e in estimate(df, rules, text_col, (), size)]
    return df.where(cascade(order, rules, F.coalesce(F.col(text_col).cast("string"), F.lit("")), ()).isNull())


def with_features(df: DataFrame, names) -> DataFrame:
    """The rows with features of their `text` as columns; words are made once for all of them."""
    df = df.withColumn("words", words(F.col("text")))
    of = feature_of(F.col("text"), ("words",))
    return df.select("*", *[of(n).alias(n) for n in names]).drop("words")


_KEPT_SQL = """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
    grams AS (SELECT r, unnest(range(1, len(words) - 1)) AS i,
                     unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS g FROM w),
    twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams),
    repeats AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1) GROUP BY r),
    f AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
                 CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
                 len(lines) AS n_lines, len(list_filter(words, lambda x: NOT regexp_matches(x, '\\p{L}'))) AS n_no_letter,
                 length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
                 length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclamations,
                 len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…) *$'))) AS n_ellipsis_lines,
                 len(list_filter(lines, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•] '))) AS n_bullet_lines
          FROM w LEFT JOIN repeats USING (r))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
                OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 30 * n_lines
                OR 100 * n_no_letter > 20 * n_words OR 100 * n_capitals > 40 * word_chars OR 100 * n_exclamations > 20 * n_words
                OR 100 * n_ellipsis_lines > 30 * n_lines OR 100 * n_bullet_lines > 90 * n_lines) AS kept FROM f"""


@query(_KEPT_SQL)
def op12_quality_rules(spark, sf_dir):
    """Features and verdicts of all documents: the base rules on the features, the cascade on what they leave."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    given = ("n_words", *BASE)
    rows = with_features(docs, given)
    of = feature_of(F.col("text"), given)
    base_failed = BASE_RULES["too_few_words"](of) | BASE_RULES["repeated_words"](of)
    order = [e.name for e in estimate(docs, METHOD_RULES, given=given)]
    good = cascade(order, METHOD_RULES, F.col("text"), given).isNull()
    return rows.select("doc_id", *given, base_failed.alias("base_failed"), F.when(base_failed, F.lit(False)).otherwise(good).alias("kept"))
