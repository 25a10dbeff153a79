"""Secret scan by assignment-aware lexing.

A text is read as source or configuration syntax: `name = literal`, `name: literal`, `"name": "literal"`, with typed
declarations, `:=` and `=>`, and literals joined by `+`, also over line ends. An unquoted value ends at white space. The name-literal pairs of a text form its constants; a name on
the right-hand side stands for the literals it is bound to before it, or else behind it, also through several steps; calls, and
names that are bound nowhere and have no digit or are named like a secret, are no literals. A literal is scored by how
sensitive its target's name is and by how random it looks; literals of at least `MIN_SCORE` are reported where they
stand in the text, as `literal` (bound directly) or `constant` (reached through another name). Three plain patterns
(`assign`, `access`, `hex`) are reported whatever the score.

Defined cases: a null or empty text has no spans; a repeated row is scanned again and reported again; an empty table
gives an empty table; columns other than id and text are ignored, whatever their names. Texts are read whole, in time about
linear in their length: targets within one unquoted run share its end, a value is scored
whole, one of more than `SCORED` characters or `LITERALS` literals from what is known of its parts, and the literals of such
values are gone through once for all names. Only names bound to each other in circles, or to several names at once, are followed
anew for each of them.
"""

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, map_batches, registry, span_list, table, texts_of

QUERIES, SQL, query = registry()

MIN_SCORE = 0.5
#: Characters and literals of the longest values that are put together to be scored; longer ones are scored by the counts of their parts.
SCORED, LITERALS = 256, 16
BASE_KINDS = ("assign", "access", "hex")
SPAN = "array<struct<kind: string, start: int, end: int, name: string, score: double>>"

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
# Runs are whole, so asking for the length at once finds the same ones as filtering them by length afterwards.
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

#: The left side of a pair: a name, perhaps quoted or with a type, and the sign that binds it.
TARGET = re.compile(r"""(?<![\w$.-])([A-Za-z_$][\w$.-]*+)["'`]?\]?[ \t]*+(?::[ \t]*+[A-Za-z_][\w.]*+[ \t]*+(?==[^=>]))?(?::=|=>|==?|:)(?!//)[ \t]*+(?=["'`]|[^\s,;:=<>(){}\[\]#])""", re.A)
#: A term of the right side: a quoted literal that ends on its line, or an unquoted value. That ends at white space (so before a
#: comment), at a quote, at a comma and the like before white space or another pair, at a closing bracket or at a markup tag.
QUOTED = re.compile(r'"((?:[^"\\\n]|\\.)*+)"|\x27((?:[^\x27\\\n]|\\.)*+)\x27|`((?:[^`\\\n]|\\.)*+)`', re.A)
BARE = re.compile(r"""(?:(?![,;:&](?:\s|\Z|["'\w$.-]++[ \t]*+[:=])|[)\]}>](?:[\s,;)\]}>"'`]|\Z)|<[/A-Za-z!])[^\s"'`])++""", re.A)
#: What joins terms: a quoted literal may be followed by it on a later line; a bare word, by the next term only.
PLUS = re.compile(r"(?:\s|\\\n)*+\+(?:\s|\\\n)*+(?=[\"'`A-Za-z_$])")
PLUS_HERE = re.compile(r"[ \t]*+\+(?:\s|\\\n)*+(?=[\"'`A-Za-z_$])")
IDENTIFIER = re.compile(r"[A-Za-z_$][\w$.]*", re.A)
PIN = re.compile(r"[0-9]{4,8}")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

# How sensitive a part of a name is, and texts that are no secrets.
NAME_WEIGHT = {
    "auth": 0.7, "authorization": 0.7, "bearer": 0.7, "cred": 0.7, "credential": 0.8, "credentials": 0.8, "key": 0.7,
    "passphrase": 0.9, "passwd": 0.9, "password": 0.9, "pin": 0.7, "private": 0.7, "pwd": 0.9, "salt": 0.7, "secret": 0.9,
    "session": 0.7, "signature": 0.7, "token": 0.8,
}
NAME_PAIRS = {("access", "key"): 0.9, ("api", "key"): 0.9, ("client", "secret"): 0.95, ("encryption", "key"): 0.9,
              ("private", "key"): 0.9, ("secret", "key"): 0.95, ("signing", "key"): 0.9}
PLACEHOLDERS = {"changeme", "dummy", "example", "false", "none", "null", "placeholder", "redacted", "test", "todo", "true", "undefined", "xxx", "your"}
#: These count wherever they stand in a value; the others, only as the whole of it.
LONG_PLACEHOLDERS = [p for p in sorted(PLACEHOLDERS) if len(p) > 4]


def name_score(name: str) -> float:
    """Of 0 to 1: the most sensitive part, or pair of parts, of an identifier in any style."""
    parts = [p.lower() for p in PARTS.findall(name)]
    compact = "".join(parts)
    found = [NAME_WEIGHT.get(p, 0.0) for p in parts] + [NAME_PAIRS.get(p, 0.0) for p in zip(parts, parts[1:])]
    found += [w for (a, b), w in NAME_PAIRS.items() if a + b in compact]
    return max(found, default=0.0)


def literal_score(value: str) -> float:
    """Of 0 to 1: long, mixed and evenly spread characters look like a generated value."""
    return Value.of(value).score()


class Value:
    """What the score of a value needs: its length, how often each character occurs, its beginning and end, and whether it has a placeholder."""

    __slots__ = ("n", "counts", "head", "tail", "placeholder")
    #: Characters of the beginning and the end: more than the longest placeholder has.
    EDGE = 16

    def __init__(self, n, counts, head, tail, placeholder):
        self.n, self.counts, self.head, self.tail, self.placeholder = n, counts, head, tail, placeholder

    @classmethod
    def of(cls, value: str):
        low = value.lower()
        return cls(len(value), Counter(value), value[:cls.EDGE], value[-cls.EDGE:], any(p in low for p in LONG_PLACEHOLDERS))

    def __add__(self, other):
        """The value with another one behind it."""
        if not self.n or not other.n:
            return self if self.n else other
        counts = self.counts.copy()
        counts.update(other.counts)
        low = (self.tail + other.head).lower()
        placeholder = self.placeholder or other.placeholder or any(p in low for p in LONG_PLACEHOLDERS)
        return Value(self.n + other.n, counts, (self.head + other.head)[:self.EDGE], (self.tail + other.tail)[-self.EDGE:], placeholder)

    def score(self) -> float:
        n, chars = self.n, self.counts.keys()
        if n < 6 or self.placeholder or n <= self.EDGE and self.head.lower() in PLACEHOLDERS:
            return 0.0
        if len(set("".join(chars).lower())) < 4 or self.head[0] in "<{%$" and self.tail[-1] in ">}%":
            return 0.0
        entropy = -sum(c / n * math.log2(c / n) for c in self.counts.values())
        classes = sum(any(map(f, chars)) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
        return min(1.0, 0.35 + 0.12 * classes + 0.1 * max(0.0, entropy - 2) - (0.4 if " " in chars else 0))


def value_score(name: str, value: Value) -> float:
    """The score of a value for a name; a `pin` is a few digits, which look like nothing by themselves."""
    if value.n <= value.EDGE and PIN.fullmatch(value.head) and "pin" in (p.lower() for p in PARTS.findall(name)):
        return 1.0 if len(value.counts) > 1 else 0.0
    return value.score()


def base_spans(text: str) -> list:
    """The plain patterns, leftmost and without overlaps per kind; ordered by start, then kind as listed."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(BASE_KINDS[k], start, end, None, 1.0) for start, k, end in sorted(found)]


class Run:
    """An unquoted run of characters that may be the value of many targets: where it ends, and what is open from any of its places on."""

    def __init__(self, text, start, end):
        self.start, self.end, self.after, self.balance = start, end, text[end:end + 64], None
        if self.after[:1] in (*")]}>",):
            # How many more of a bracket are opened than closed from each place to the end.
            codes = np.frombuffer(text[start:end].encode("utf-32-le"), "<u4")
            count = lambda c: (codes == ord(c)).astype(np.int64)
            self.balance = {b: np.cumsum((count(a) - count(b))[::-1])[::-1] for a, b in ("()", "[]", "{}", "<>")}

    def closed(self, text, at):
        """The end of the value from a place on, with the brackets behind the run that were opened in it."""
        end = self.end
        if self.balance:
            missing = {b: int(n[at - self.start]) for b, n in self.balance.items()}
            while missing.get(text[end:end + 1], 0) > 0:
                missing[text[end]] -= 1
                end += 1
        return end


def pairs(text: str):
    """(name, terms) for each assignment, in order; a term is the place of a literal, and whether it is unquoted.

    Targets within an unquoted run share it: a run ends at the same place wherever it is begun.
    """
    run = Run(text, 0, 0)
    for target in TARGET.finditer(text):
        at, terms = target.end(), []
        while at < len(text):
            if term := QUOTED.match(text, at):
                terms.append((*term.span(term.lastindex), False))
                plus = PLUS.match(text, term.end())
            else:
                if not run.start <= at < run.end:
                    if not (term := BARE.match(text, at)):
                        break
                    run = Run(text, *term.span())
                end = run.closed(text, at)
                terms.append((at, end, True))
                plus = PLUS_HERE.match(text, end)
            if not plus:
                break
            at = plus.end()
        if terms:
            yield target.group(1), terms


def binding(bound, text, start, end, at):
    """The pair that a name stands for in the pair `at`: the last one before it, or else the first one behind it."""
    name = IDENTIFIER.match(text, start, end)
    places = bound.get(name.group(), ()) if name and name.end() == end else ()
    i = bisect_left(places, at)
    return places[i - 1] if i else next((to for to in places[:2] if to != at), None)


def is_expression(text, start, end):
    """Whether an unquoted value is a call, or a name that is nowhere bound: one with a digit may be a password, unless it is named like one."""
    name = IDENTIFIER.match(text, start, end)
    if not name or name.end() < end and not (text[name.end()] in "([" and text[end - 1] in "()[]"):
        return False
    if name.end() < end:
        return True
    return not any(c.isdigit() for c in name.group()) or name_score(name.group()) > 0


def reached(text, found, bound, at, done, most=math.inf):
    """Places of the literals that the pair `at` is made of, in order, and whether another name was followed to them; pairs in `done` are
    not entered, and those that are, are put into it, `most` at most."""
    through, left = False, [(at, term) for term in reversed(found[at][1])]
    done.add(at)
    while left:
        of, (start, end, bare) = left.pop()
        to = binding(bound, text, start, end, of) if bare else None
        if to is None:
            if not bare or not is_expression(text, start, end):
                yield start, end, through
        else:
            through = True
            if to not in done and len(done) < most:
                done.add(to)
                left += [(to, term) for term in reversed(found[to][1])]


def lexed_spans(text: str, min_score: float = MIN_SCORE) -> list:
    """Literals that a sensitive name is bound to; each place once, with its best score."""
    if "=" not in text and ":" not in text:
        return []
    best, bound, found, large, whole = {}, {}, list(pairs(text)), [], None
    for at, (name, _) in enumerate(found):
        bound.setdefault(name, []).append(at)

    def report(places, name, score, through):
        kind = "constant" if through else "literal"
        for start, end in places:
            if end > start and score > best.get((start, end), ("", "", 0.0))[2]:
                best[start, end] = (kind, name, score)

    for at, (name, _) in enumerate(found):
        if not (weight := name_score(name)):
            continue
        done = set()
        some = list(islice(reached(text, found, bound, at, done, LITERALS + 1), LITERALS + 1))
        places, through = dict.fromkeys((start, end) for start, end, _ in some[:LITERALS]), any(t for _, _, t in some)
        if len(some) <= LITERALS and len(done) <= LITERALS and sum(end - start for start, end in places) <= SCORED:
            value = Value.of("".join([text[start:end] for start, end in places]))
        else:
            whole = whole or Wholes(text, found, bound)
            value = whole.of(at)
        if (score := round(weight * value_score(name, value), 4)) >= min_score:
            if len(some) > LITERALS or len(done) > LITERALS:
                large.append((-score, at, name))
            else:
                report(places, name, score, through)
    # Values of very many literals: the best first, and what one has reported need not be looked at by the others.
    done = set()
    for score, at, name in sorted(large):
        if at not in done:
            for start, end, through in reached(text, found, bound, at, done):
                report([(start, end)], name, -score, through)
    return [(kind, start, end, name, score) for (start, end), (kind, name, score) in sorted(best.items())]


class Parts:
    """Values of any parts of a text, from counts of its characters up to every `step`-th place."""

    def __init__(self, text):
        self.text, codes = text, np.frombuffer(text.encode("utf-32-le"), "<u4")
        chars, self.codes = np.unique(codes, return_inverse=True)
        self.chars, size = np.array(list(map(chr, chars.tolist())), object), len(chars)
        self.step = max(1024, len(text) * size // 2_000_000)
        blocks = np.arange(len(text)) // self.step
        counts = np.bincount(blocks * size + self.codes, minlength=(len(text) // self.step + 1) * size).reshape(-1, size)
        self.before = np.concatenate([np.zeros((1, size), np.int64), np.cumsum(counts, axis=0)])
        low = text.translate(ASCII_LOWER)
        self.starts = {p: [m.start() for m in re.finditer(p, low)] for p in LONG_PLACEHOLDERS if p in low}

    def up_to(self, at):
        block = at // self.step
        return self.before[block] + np.bincount(self.codes[block * self.step:at], minlength=len(self.chars))

    def value(self, start, end) -> Value:
        if end - start <= SCORED:
            return Value.of(self.text[start:end])
        counts = self.up_to(end) - self.up_to(start)
        there = np.flatnonzero(counts)
        inside = lambda p, starts: (i := bisect_left(starts, start)) < len(starts) and starts[i] + len(p) <= end
        edge = Value.EDGE
        return Value(end - start, Counter(dict(zip(self.chars[there].tolist(), counts[there].tolist()))), self.text[start:start + edge],
                     self.text[end - edge:end], any(inside(p, starts) for p, starts in self.starts.items()))


#: Lower-casing that keeps every place: all characters that become ASCII letters.
ASCII_LOWER = {c: chr(c).lower() for c in (*range(ord("A"), ord("Z") + 1), 0x212A)}


class Wholes:
    """The whole values of pairs, whatever their number of literals: a value that is bound to one other name is made of that name's value."""

    def __init__(self, text, found, bound):
        self.text, self.found, self.bound, self.parts, self.known = text, found, bound, Parts(text), {}
        # A place that several terms share counts once in a value: then all values are gone through.
        places = [term[:2] for _, terms in found for term in terms]
        self.apart = len(places) == len(set(places))

    def terms(self, at):
        """(the pair that a term stands for, its place or None if it is no literal) for each term."""
        for start, end, bare in self.found[at][1]:
            to = binding(self.bound, self.text, start, end, at) if bare else None
            yield to, None if to is not None or bare and is_expression(self.text, start, end) else (start, end)

    def follow(self, at):
        """The value of a pair by going through all that it reaches, and the pairs on the way."""
        done = set()
        places = dict.fromkeys((start, end) for start, end, _ in reached(self.text, self.found, self.bound, at, done))
        value = Value.of("".join([self.text[start:end] for start, end in places if end - start <= SCORED]))
        if any(end - start > SCORED for start, end in places):
            value = Value.of("")
            for start, end in places:
                value = value + self.parts.value(start, end)
        return value, done

    def of(self, first) -> Value:
        path, at = {}, first
        while at not in self.known:
            if at in path:
                for within in list(path)[list(path).index(at):]:
                    self.known[within] = self.follow(within)
                break
            terms = list(self.terms(at))
            names = {to for to, _ in terms if to is not None}
            if len(names) > 1 or not self.apart:
                self.known[at] = self.follow(at)
                break
            path[at] = terms
            if not names:
                break
            at = names.pop()
        for at, terms in reversed(path.items()):
            if at in self.known:
                continue
            name = next((to for to, _ in terms if to is not None), None)
            of_name, reach = self.known[name] if name is not None else (None, ())
            # What the name is bound to may lead back to this pair: then it is part of a circle, and ends where it began.
            if at in reach:
                self.known[at] = self.follow(at)
                continue
            value = Value.of("")
            for to, place in terms:
                if place:
                    value = value + self.parts.value(*place)
                elif to is not None and of_name:
                    value, of_name = value + of_name, None  # a second time, it is there already
            self.known[at] = value, reach
        return self.known[first][0]


def find_secrets(df: DataFrame, id_col="doc_id", text_col="text", min_score=MIN_SCORE) -> DataFrame:
    """One row per row: the id, `base` (plain patterns) and `lexed` (scored literals) as arrays of spans in code points."""
    def step(batch):
        texts = texts_of(batch)
        as_structs = lambda spans: [dict(zip(("kind", "start", "end", "name", "score"), s)) for s in spans]
        return {"doc_id": batch.column("doc_id"), "base": [as_structs(base_spans(t)) for t in texts],
                "lexed": [as_structs(lexed_spans(t, min_score)) for t in texts]}
    return map_batches(id_and_text(df, id_col, text_col), step, f"doc_id long, base {SPAN}, lexed {SPAN}")


@query()
def op1_secret_scan(spark, sf_dir):
    """Counts and spans of secrets in all documents."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    found = find_secrets(table(spark, sf_dir, "documents"))
    order = F.array_sort(F.concat("base", "lexed"), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0))
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(span_list("base"), 256).alias("base_sha256"), span_list(order).alias("spans"),
                        F.size("lexed").cast("long").alias("n_lexed"))
