"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust their score.

Kinds `email`, `ip`, `card` (Luhn) and `phone` are always reported once their own check has passed; `iban` (mod-97), `ssn` and
`id` (a number without marks, of a passport, say) are reported from a score of `MIN_SCORE`. A score begins with the weight of the kind; the nearest
context word of the clause, within `CONTEXT` characters, raises or lowers it, and the more the nearer it is.

Defined cases: a null or empty text has no spans; repeated rows are each reported; an empty table gives an empty table;
columns other than id and text are ignored, whatever their names. Time is linear in the text for every pattern.
"""

import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, functions as F

from .common import id_and_text, map_batches, registry, span_list, table, texts_of

QUERIES, SQL, query = registry()

MIN_SCORE, CONTEXT = 0.5, 40
BASE_KINDS = ("email", "ip", "card", "phone")
SPAN = "array<struct<kind: string, start: int, end: int, score: double>>"

# Characters before the @, pattern texts, weights and context words of each kind, IBAN lengths.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive and anchored at the start of a run: the same matches as the plain patterns, without re-reading a run.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: The start of an IBAN, and what may follow it: 34 characters at most in all.
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
IBAN_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
#: Nine digits, or a letter and eight, that are a social security or passport number only if a word beside them says so.
BARE = re.compile(r"(?<![A-Za-z0-9+.-])(?:[A-Z][0-9]{8}|(?!000|666|9)[0-9]{9})(?![A-Za-z0-9-]|\.[0-9])")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
WEIGHT = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.85, "ssn": 0.4, "id": 0.35}
FOR = {
    "email": ("contact", "e-mail", "email", "mail", "write"), "ip": ("address", "host", "ip", "server"),
    "card": ("card", "credit", "debit", "mastercard", "payment", "visa"), "phone": ("call", "fax", "mobile", "phone", "tel", "telephone"),
    "iban": ("account", "bank", "bic", "iban", "transfer"), "ssn": ("insurance", "social", "ssn", "tax"),
    "id": ("passport", "social", "ssn", "tax"),
}
AGAINST = ("example", "invoice", "isbn", "order", "sample", "serial", "version")
IBAN_LENGTH = {"AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21,
               "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18,
               "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23,
               "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
               "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28,
               "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
               "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
               # In use without being in the registry.
               "AO": 25, "BF": 28, "BJ": 28, "CF": 27, "CG": 27, "CI": 28, "CM": 27, "CV": 25, "DZ": 26, "GA": 27, "GQ": 27, "GW": 25, "IR": 26,
               "KM": 27, "MA": 28, "MG": 27, "ML": 28, "MZ": 25, "NE": 28, "SN": 28, "TD": 27, "TG": 28}
WORD = re.compile(r"[A-Za-z][A-Za-z-]*", re.A)
CLAUSE = re.compile(r"[;!?\n]|\.(?=\s)")
CLAUSE_OR_COMMA = re.compile(r"[,;!?\n]|\.(?=\s|$)")
REDACTED = {k: f"[{k.upper()}]" for k in WEIGHT}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text):
    """Local part, @ and dotted domain; each @ is looked at once, from the run of characters before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at) if local else None
        if domain:
            yield at - local, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def ips(text):
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def cards(text):
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := re.sub("[ -]", "", m.group())) <= 19 and luhn(digits):
            yield m.span()


def phones(text):
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                yield m.span()


def _ibans(text, at, end, listed):
    """IBANs of listed, or of other countries, from `at` to `end`; the search goes on behind one, or behind the start of none."""
    while m := IBAN.search(text, at, end):
        at = m.start() + 1
        n = IBAN_LENGTH.get(m.group()[:2])
        if listed != (n is not None) or not (rest := IBAN_REST.match(text, m.end(), end)):
            continue
        ends = [i + 1 for i in range(m.start(), rest.end()) if text[i] != " "]
        compact = text[m.start():rest.end()].replace(" ", "")
        for n in (n,) if listed else range(len(compact), 14, -1):
            if n <= len(compact) and not text[ends[n - 1]:ends[n - 1] + 1].isalnum() and mod97(compact[:n]):
                yield m.start(), (at := ends[n - 1])
                break


def ibans(text):
    """A listed country's IBAN has its length; between those, one of another country ends at the last end of a group that passes."""
    at = 0
    for start, end in [*_ibans(text, 0, len(text), True), (len(text), len(text))]:
        yield from _ibans(text, at, start, False)
        if end > start:
            yield start, end
        at = end


def ssns(text):
    for m in SSN.finditer(text):
        yield m.span()


def bare_numbers(text):
    for m in BARE.finditer(text):
        yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ssn": ssns, "id": bare_numbers}
PROPOSES = re.compile("[0-9@]")


def context(text, kind, start, end, before, after):
    """(distance, whether it speaks for the kind) of the nearest context word; None without one.

    The context ends at `CONTEXT` characters, at the proposals on either side, and where the clause ends: to the left at a
    semicolon, a sentence or a line, to the right at a comma as well. Words that reach over its edge do not count.
    """
    low, high = max(before, start - CONTEXT), min(after, end + CONTEXT)
    for m in CLAUSE.finditer(text, low, start):
        low = m.end()
    if m := CLAUSE_OR_COMMA.search(text, end, high):
        high = m.start()
    words = [(start - m.end(), m) for m in WORD.finditer(text, low, start)] + [(m.start() - end, m) for m in WORD.finditer(text, end, high)]
    whole = lambda m: not text[max(0, m.start() - 1):m.start()].isalnum() and not text[m.end():m.end() + 1].isalnum()
    found = [(n, m.group().lower()) for n, m in words if whole(m)]
    return min(((n, w in FOR[kind]) for n, w in found if w in FOR[kind] or w in AGAINST), key=lambda x: x[0], default=None)


def scored(text, kind, start, end, before=0, after=None):
    """The weight of the kind, moved by the nearest context word, and less so the farther it is; of words equally near, the one before counts."""
    near = context(text, kind, start, end, before, len(text) if after is None else after)
    if near is None:
        return WEIGHT[kind]
    distance, speaks_for = near
    pull = 1 - distance / (2 * CONTEXT)
    return round(min(1.0, WEIGHT[kind] + 0.2 * pull) if speaks_for else WEIGHT[kind] * (1 - 0.3 * pull), 4)


def find_in(text: str, min_score: float = MIN_SCORE):
    """Spans of a text: those that are always reported, by kind as listed, then start; and those added by score."""
    base, added = [], []
    if PROPOSES.search(text):
        proposed = [(kind, start, end) for kind, find in FINDERS.items() for start, end in find(text)]
        # The nearest proposals that end before and begin behind a span bound its context.
        ends, starts = sorted(e for _, _, e in proposed), sorted(s for _, s, _ in proposed)
        for kind, start, end in proposed:
            i, j = bisect_right(ends, start), bisect_left(starts, end)
            score = scored(text, kind, start, end, ends[i - 1] if i else 0, starts[j] if j < len(starts) else len(text))
            if kind in BASE_KINDS:
                base.append((kind, start, end, score))
            elif score >= min_score:
                added.append((kind, start, end, score))
    return base, added


def redact(text: str, spans) -> str:
    """Each span as the name of its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for start, end, kind in sorted((s[1], -s[2], s[0]) for s in spans):
        end = -end
        if start >= at:
            out += [text[at:start], REDACTED[kind]]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_pii(df: DataFrame, id_col="doc_id", text_col="text", min_score=MIN_SCORE) -> DataFrame:
    """One row per row: the id, `base` and `added` spans (code points, end exclusive) and the `redacted` text (null if nothing was found)."""
    def step(batch):
        base, added, clean = [], [], []
        as_structs = lambda spans: [dict(zip(("kind", "start", "end", "score"), s)) for s in spans]
        for text in texts_of(batch):
            b, a = find_in(text, min_score)
            base.append(as_structs(b))
            added.append(as_structs(a))
            clean.append(redact(text, b + a) if b or a else None)
        return {"doc_id": batch.column("doc_id"), "base": base, "added": added, "redacted": clean}
    return map_batches(id_and_text(df, id_col, text_col), step, f"doc_id long, base {SPAN}, added {SPAN}, redacted string")


def redact_texts(df: DataFrame, text_col="text", min_score=MIN_SCORE) -> DataFrame:
    """The same rows and columns with personal data replaced in the text column; a null text stays null."""
    def step(batch):
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        texts = columns[text_col].to_pylist()
        columns[text_col] = [t if t is None or not any(found := find_in(t, min_score)) else redact(t, found[0] + found[1]) for t in texts]
        return columns
    return map_batches(df, step, df.schema.toDDL())


@query()
def op3_pii(spark, sf_dir):
    """Counts and spans of personal data in all documents."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS], F.sha2(span_list("base"), 256).alias("base_sha256"),
                        span_list(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"),
                        F.array_join(F.transform(F.concat("base", "added"), lambda s: s["score"].cast("string")), ",").alias("scores"))
