"""Alignment of two tokenizers by anchors at white space.

A text is tokenised whole by both tokenizers, A with a space put before it, B as it is (it puts one there itself). A byte
offset at which both have a token's end and after which both go on with a token that is marked by a space is an anchor; the
anchors split the document into windows of A ids and B ids. Texts are made of the same words again and again, so a window is
aligned once per worker and remembered by its tuples of ids: its groups (cut wherever both tokens end), its links (pairs of
tokens whose bytes overlap), and whether its ids really spell the same bytes on both sides.

How often a pair of ids is linked over the corpus is counted from per-document counts, which are stored: they are summed up in
the tasks that read them before anything is shuffled. Looking the counts up again has two tiers: the `TABLE` most frequent
pairs go to every task, a table of fixed size that holds every hot key; the others meet their counts in a join. A pair is the
best of its B id if none of that id's pairs has a higher count.

Defined cases: a null or empty text, and one whose tokens do not spell it (a text with U+2581, which B cannot tell from a
space), has no tokens, zeros and an empty list of groups; repeated rows, equal and null ids are each aligned and counted; an
empty table gives an empty table; columns other than id and text are ignored, whatever their names. Ties for the best pair all
count. Texts are aligned whole, in time linear in their length; windows of over `LONGEST` tokens are not remembered.
"""

import hashlib
from math import prod

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, Window, functions as F

from ..operators.skew import own_shuffle
from ..session import cut_lineage
from .common import id_and_text, map_batches, registry, table, texts_of
from .packing import _as_bytes
from .piece_codec import BYTE, SPACE, model_bytes, parse_model, read_model
from .pretokens import CACHE, Recent, Splitter, byte_letters, of_worker, unassigned
from .token_counts import read_spec

QUERIES, SQL, query = registry()

#: Windows that a worker remembers (or twice as many, see Recent), and the tokens of the longest of them.
WINDOWS, LONGEST = 400_000, 64
#: Stands between the ids of both sides; no id.
MARK = (1 << 32) - 1
#: Pairs of ids whose corpus-wide counts go to every task.
TABLE = 65_536
DOCUMENT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def bytes_of_a(splitter: Splitter) -> list:
    """The bytes of each id of a byte-level vocabulary."""
    letters = byte_letters()
    byte_of = {letters.get(b, chr(b)): b for b in range(256)}
    vocab = splitter.tokenizer.get_vocab(with_added_tokens=False)
    found = [b""] * splitter.tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in vocab.items():
        found[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
    return found


def bytes_of_b(model: dict) -> list:
    """The bytes of each id of a piece model: a mark is a space, a byte piece its byte."""
    return [bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(SPACE, " ").encode() for piece, _, kind in model["pieces"]]


def align(a, b, length_a, length_b):
    """For ids of both sides that spell the same bytes: (which token of A, which of B) for each link, and each token's group.

    Between two neighbouring ends, of whichever side, lies in one token of A and one of B: each such stretch of bytes is a link, and all
    links are such stretches. A group ends where both sides have an end.
    """
    end_a, end_b = np.cumsum(length_a[a]), np.cumsum(length_b[b])
    ends = np.union1d(end_a, end_b)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    link_a, link_b = np.searchsorted(end_a, begins, "right"), np.searchsorted(end_b, begins, "right")
    shared = end_a[np.isin(end_a, end_b, assume_unique=True)]
    return link_a, link_b, np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)


class Aligner:
    """Aligns the texts of a worker's batches; remembers windows by their ids."""

    def __init__(self, spec: str, model_file: bytes, windows=WINDOWS):
        self.splitter, model = Splitter(spec), parse_model(model_file)
        self.whole = Splitter(spec).tokenizer
        self.whole.encode_special_tokens = True
        self.ids_of_piece = Recent(CACHE, lambda piece: self.spelling(piece, self.splitter.encode_piece(piece)))
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model_file)
        self.of_a, self.of_b = bytes_of_a(self.splitter), bytes_of_b(model)
        self.length_a, self.length_b = (np.array([len(t) for t in of], np.int64) for of in (self.of_a, self.of_b))
        self.space_a, self.space_b = (np.array([t[:1] == b" " for t in of]) for of in (self.of_a, self.of_b))
        # An id with what stands behind it in a list of groups: another id of its side, the other side, the next group, or nothing.
        self.written = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(max(len(self.of_a), len(self.of_b)))]
        self.known = Recent(windows)

    def spelling(self, text: str, ids) -> bytes:
        """The ids of A if they spell the text, else none."""
        return _as_bytes(ids) if b"".join(map(self.of_a.__getitem__, ids)) == text.encode() else b""

    def ids_a(self, text: str) -> bytes:
        """Ids of a space and the text; special strings in it are plain text. As each piece is spelt by its ids, all of them spell the text if
        they have as many bytes."""
        text = " " + text
        if unassigned(text):
            return self.spelling(text, self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.ids_of_piece.__getitem__, self.splitter.pieces(text)))

    def cuts(self, a, b, starts_a, starts_b):
        """Where windows begin, as places in the ids of both sides: the starts of texts, the anchors, and the end. All texts are spelt by
        both sides, so offsets run on over them."""
        first_a, first_b = self.space_a[a], self.space_b[b]
        first_a[starts_a], first_b[starts_b] = True, True
        first_a, first_b = np.flatnonzero(first_a), np.flatnonzero(first_b)
        offset_a, offset_b = (np.concatenate([[0], np.cumsum(length[ids])])[first] for length, ids, first in
                              ((self.length_a, a, first_a), (self.length_b, b, first_b)))
        place = np.searchsorted(offset_b, offset_a)
        shared = np.flatnonzero(np.append(offset_b, -1)[place] == offset_a)
        return first_a[shared], first_b[place[shared]]

    def agree(self, a, b, ends_a, ends_b):
        """Which windows are spelt alike by both sides; all of them at once, and one by one only if they are not."""
        spelt_a, spelt_b = (list(map(of.__getitem__, ids.tolist())) for of, ids in ((self.of_a, a), (self.of_b, b)))
        if b"".join(spelt_a) == b"".join(spelt_b):
            return np.ones(len(ends_a), bool)
        begins = zip([0, *ends_a[:-1]], ends_a, [0, *ends_b[:-1]], ends_b)
        return np.array([b"".join(spelt_a[i:k]) == b"".join(spelt_b[j:m]) for i, k, j, m in begins])

    def align_windows(self, a, b, ends_a, ends_b) -> list:
        """The groups of windows as text, their number, and their links as keys, all of them aligned in one go; None if the two sides do not
        spell the same. The windows have the same number of bytes on both sides."""
        good = self.agree(a, b, ends_a, ends_b)
        link_a, link_b, group_a, group_b = align(a, b, self.length_a, self.length_b)
        links = (a[link_a].astype(np.int64) * len(self.of_b) + b[link_b]).tobytes()
        # All ids by group, those of A first, each with the mark behind it.
        group = np.concatenate([group_a, group_b])
        order = np.lexsort((np.arange(len(group)) >= len(a), group))
        group, side = group[order], order >= len(a)
        mark = np.append(np.where(group[1:] != group[:-1], 2, np.where(side[1:] != side[:-1], 1, 0)), 3)
        ends = ends_a + ends_b
        mark[ends - 1] = 3  # the last id of each window
        written = [self.written[i] for i in (np.concatenate([a, b])[order] + mark * (len(self.written) // 4)).tolist()]
        n_groups = np.diff(np.concatenate([[0], group_a[ends_a - 1] + 1]))
        found, at, at_link = [], 0, 0
        for end, groups, end_link in zip(ends.tolist(), n_groups.tolist(), (8 * np.searchsorted(link_a, ends_a)).tolist()):
            found.append(("".join(written[at:end]), groups, links[at_link:end_link]))
            at, at_link = end, end_link
        return [w if ok else (None, 0, b"") for w, ok in zip(found, good.tolist())]

    def windows(self, a, b, cuts_a, cuts_b) -> list:
        """The aligned windows of some texts. A window's key are its ids of A, a mark and its ids of B."""
        known, found, new = self.known, [], {}
        get = known.get
        sizes_a, sizes_b = np.diff(np.append(cuts_a, len(a))), np.diff(np.append(cuts_b, len(b)))
        numbers = np.arange(len(cuts_a))
        both = np.full(len(a) + len(b) + len(numbers), MARK, "<u4")
        both[np.arange(len(a)) + np.repeat(numbers + cuts_b, sizes_a)] = a
        both[np.arange(len(b)) + np.repeat(numbers + 1 + cuts_a + sizes_a, sizes_b)] = b
        both, ends = both.tobytes(), (4 * np.cumsum(sizes_a + sizes_b + 1)).tolist()
        for k, (i, j) in enumerate(zip([0, *ends], ends)):
            key = both[i:j]
            found.append(get(key) or known.recall(key) or new.setdefault(key, k))
        # (A window's number may be 0: then it is new, too.)
        if new:
            at = np.fromiter(new.values(), np.int64, len(new))
            chosen = lambda cuts, sizes: np.repeat(cuts[at] - np.concatenate([[0], np.cumsum(sizes[at])[:-1]]), sizes[at]) + np.arange(sizes[at].sum())
            aligned = self.align_windows(a[chosen(cuts_a, sizes_a)], b[chosen(cuts_b, sizes_b)], np.cumsum(sizes_a[at]), np.cumsum(sizes_b[at]))
            of_number = dict(zip(new.values(), aligned))
            found = [of_number[w] if type(w) is int else w for w in found]
            for key, window in zip(new, aligned):
                if len(key) <= 8 * LONGEST:
                    known.learn(key, window)
        return found

    def documents(self, texts) -> list:
        """For each text n_a, n_b, n_groups, n_links, groups as text, keys of links and how often each occurs; None if the tokens do not
        spell it."""
        out, ids = [None] * len(texts), []
        for k, (text, b) in enumerate(zip(texts, self.pieces.encode(texts, num_threads=1))):
            a, b = np.frombuffer(self.ids_a(text) if text else b"", "<u4"), np.array(b, "<u4")
            if text and self.length_a[a].sum() == self.length_b[b].sum() == len(text.encode()) + 1:
                ids.append((k, a, b))
        if not ids:
            return out
        a, b = (np.concatenate([x[side] for x in ids]) for side in (1, 2))
        starts_a, starts_b = (np.cumsum([0] + [len(x[side]) for x in ids[:-1]]) for side in (1, 2))
        cuts_a, cuts_b = self.cuts(a, b, starts_a, starts_b)
        found = self.windows(a, b, cuts_a, cuts_b)
        at = np.searchsorted(cuts_a, starts_a).tolist()
        for (k, a, b), begin, end in zip(ids, at, [*at[1:], len(found)]):
            of_text = found[begin:end]
            groups = [w[0] for w in of_text]
            if None not in groups:
                links = np.frombuffer(b"".join([w[2] for w in of_text]), np.int64)
                keys, counts = np.unique(links, return_counts=True)
                out[k] = len(a), len(b), sum([w[1] for w in of_text]), len(links), ";".join(groups), keys, counts
        return out


def _lists(arrays, kind):
    ends = np.cumsum([0] + [len(x) for x in arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]).astype(kind)))


def align_texts(df: DataFrame, tokenizer: str, model: str, id_col="doc_id", text_col="text", with_groups=False) -> DataFrame:
    """One row per row: the id, numbers of tokens, groups and links, the digest of the groups (and the groups themselves on
    request), `pairs` (id of A times the size of B's vocabulary, plus id of B) and `times` (how often each is linked)."""
    spec = read_spec(tokenizer)
    sent = df.sparkSession.sparkContext.broadcast((spec, model_bytes(model)))
    kind = "int" if prod((Splitter(spec).tokenizer.get_vocab_size(with_added_tokens=True), len(read_model(model)["pieces"]))) < 1 << 31 else "long"
    none = np.zeros(0, np.int64)

    def step(batch):
        aligner = of_worker(("aligner", tokenizer, model), lambda: Aligner(*sent.value))
        found = aligner.documents(texts_of(batch))
        out = {"doc_id": batch.column("doc_id")}
        for k, name in enumerate(("n_a", "n_b", "n_groups", "n_links")):
            out[name] = [d[k] if d else 0 for d in found]
        out["groups_sha256"] = [hashlib.sha256(d[4].encode()).hexdigest() if d else "" for d in found]
        out["pairs"] = _lists([d[5] if d else none for d in found], np.int32 if kind == "int" else np.int64)
        out["times"] = _lists([d[6] if d else none for d in found], np.int32)
        if with_groups:
            out["groups"] = [d[4] if d else "" for d in found]
        return out
    return map_batches(id_and_text(df, id_col, text_col), step, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                       f"pairs array<{kind}>, times array<int>" + ", groups string" * with_groups)


def _values(batch, name):
    return batch.column(name).flatten().to_numpy(zero_copy_only=False)


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """pair, n (its links in the whole corpus) and best (none of its B id's pairs has more). A window holds at most A's vocabulary."""
    def sums(batch):
        pairs, place = np.unique(_values(batch, "pairs"), return_inverse=True)
        return {"pair": pairs.astype(np.int64), "n": np.bincount(place, _values(batch, "times"), len(pairs)).astype(np.int64)}
    counts = map_batches(aligned.select("pairs", "times"), sums, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    of_b = Window.partitionBy(F.pmod("pair", F.lit(size_b)))
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_b)).alias("best"))


def with_counts(aligned: DataFrame, counts: DataFrame, size=TABLE) -> DataFrame:
    """The documents (stored, with a `row` of their own) with `n_best` and `count_sum`; one row per row."""
    hot = counts.orderBy(F.desc("n"), "pair").limit(size).orderBy("pair").toArrow()  # a table of fixed size
    sent = aligned.sparkSession.sparkContext.broadcast([hot[c].to_numpy() for c in ("pair", "n", "best")])
    columns = [f for f in aligned.schema.fields if f.name in DOCUMENT]

    def step(batch):
        pair, n, best = sent.value
        keys, times = _values(batch, "pairs").astype(np.int64), _values(batch, "times").astype(np.int64)
        owner = np.repeat(np.arange(batch.num_rows), batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False))
        at = np.minimum(np.searchsorted(pair, keys), len(pair) - 1) if len(pair) else np.zeros(len(keys), np.int64)
        there = pair[at] == keys if len(pair) else np.zeros(len(keys), bool)
        total = lambda amounts: _sums(owner[there], amounts, batch.num_rows)
        n_best = total(np.where(best[at[there]], times[there], 0))
        count_sum = total(times[there] * n[at[there]])
        rest = np.flatnonzero(~there)
        # A document's own row first, then one row for each pair that is not in the table.
        filled = lambda values, kind: pa.concat_arrays([pa.array(values, kind), pa.nulls(len(rest), kind)])
        padded = lambda values, kind: pa.concat_arrays([pa.nulls(batch.num_rows, kind), pa.array(values, kind)])
        rows = batch.column("row").to_numpy(zero_copy_only=False)
        out = {"row": np.concatenate([rows, rows[owner[rest]]]), "pair": padded(keys[rest], pa.int64()), "times": padded(times[rest], pa.int64()),
               "n_best": filled(n_best, pa.int64()), "count_sum": filled(count_sum, pa.int64())}
        for f in columns:
            column = batch.column(f.name)
            out[f.name] = pa.concat_arrays([column, pa.nulls(len(rest), column.type)])
        return out
    schema = "row long, pair long, times long, n_best long, count_sum long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    looked_up = cut_lineage(map_batches(aligned, step, schema))
    rest = looked_up.where("pair IS NOT NULL").select("row", "pair", "times").join(own_shuffle(counts), "pair")
    rest = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    whole = looked_up.where("pair IS NULL").drop("pair", "times").unionByName(rest, allowMissingColumns=True)
    sums = [F.sum(c).alias(c) for c in ("n_best", "count_sum")]
    return whole.groupBy("row").agg(*[F.max(f.name).alias(f.name) for f in columns], *sums).drop("row")


def _sums(owner, amounts, n):
    """Exact sums of whole numbers by owner, which is in ascending order."""
    ends = np.concatenate([[0], np.cumsum(amounts)])
    bounds = np.searchsorted(owner, np.arange(n + 1))
    return ends[bounds[1:]] - ends[bounds[:-1]]


def aligned_with_counts(df: DataFrame, tokenizer: str, model: str, id_col="doc_id", text_col="text", size=TABLE) -> DataFrame:
    """One row per row: the id, numbers of tokens, groups and links, the digest of the groups, links that are the best of their
    B id, and the sum of the links' corpus-wide counts."""
    aligned = cut_lineage(align_texts(df, tokenizer, model, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    counts = cut_lineage(pair_counts(aligned, len(read_model(model)["pieces"])))
    return with_counts(aligned, counts, size)


@query()
def op13_token_alignment(spark, sf_dir):
    """All documents aligned between a byte-level and a piece vocabulary."""
    return aligned_with_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))
