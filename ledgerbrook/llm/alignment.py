"""Cross-tokenizer alignment by products of sparse incidence matrices.

A text is tokenised by A and by B. The incidence of tokens and bytes is a sparse 0/1 matrix per tokenizer, in
compressed rows built here; the row-by-row product A B' holds how many bytes two tokens share (overlap
links). Byte offsets where tokens of both end cut the text into groups; the product of the incidences of tokens and
groups holds the pairs of tokens that share a group (shared-group links), and that of
groups and ids counts them per pair of ids.

Neither tokenizer joins what stands before a space with what follows it, so a text falls into units (a space
and what follows), no group reaches over two of them, and the matrices are block diagonal. A task multiplies the
blocks of the distinct units it meets and sums per document by one more product, documents x units times
units x pairs. How many documents hold a pair is counted by Spark from these rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Units that a task remembers, and their code points; beyond, it starts anew.
KNOWN_UNITS = 400_000
KNOWN_SIZE = 1 << 23
#: Products that are expanded at a time; a row is never divided.
EXPANDED = 1 << 21
#: Code points of the documents that are summed at a time; a longer one is summed alone.
PIECE = 1 << 20
#: Most id pairs whose counts are sent to all tasks (16 bytes each); more are joined by shuffles.
BROADCAST_PAIRS = 2_000_000

#: Units that are tokenised as one text.
BUNDLE = 512

MARK = "▁"
#: How the byte-level tokenizer divides a text into words (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters from here on are left to the tokenizer's own tables, so are long words.
LATIN = 0x250
_EXOTIC = re.compile(f"[^\0-{chr(LATIN - 1)}]")
ROW = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, pairs array<long>, times array<long>"


# ---- sparse matrices -------------------------------------------------------------------------


@dataclass(frozen=True)
class Csr:
    """Row r has the columns `indices[starts[r]:starts[r + 1]]` with the values `data` of the same places."""

    starts: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.starts)

    @staticmethod
    def of(rows: np.ndarray, columns: np.ndarray, data: np.ndarray, height: int, width: int) -> Csr:
        """From triples in any order; values of equal places are added."""
        key = rows * width + columns
        if len(key) > 1 and not (key[1:] > key[:-1]).all():
            order = np.argsort(key, kind="stable")
            key, data = key[order], data[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            key, data = key[first], np.add.reduceat(data, first)
        starts = np.searchsorted(key, np.arange(height + 1) * width)
        return Csr(starts, key % width if width else key, data, width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(self.height), self.lengths)
        return Csr.of(self.indices, rows, self.data, self.width, self.height)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row r is the sum of the rows of `other` that the entries of row r name, weighted by them.
        Rows are taken in runs of at most EXPANDED terms."""
        reach = other.lengths[self.indices]
        before = np.r_[0, np.cumsum(reach)]
        terms = before[self.starts]
        parts, row = [], 0
        while row < self.height:
            end = max(row + 1, int(np.searchsorted(terms, terms[row] + EXPANDED, "right")) - 1)
            a, b = self.starts[row], self.starts[end]
            if size := int(before[b] - before[a]):
                entry = np.repeat(np.arange(a, b), reach[a:b])
                place = np.arange(size) - (before[entry] - before[a]) + other.starts[self.indices[entry]]
                owner = np.repeat(np.arange(end - row), self.lengths[row:end])[entry - a]
                parts.append(Csr.of(owner, other.indices[place], self.data[entry] * other.data[place], end - row, other.width))
            else:
                parts.append(Csr(np.zeros(end - row + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), other.width))
            row = end
        return stacked(parts, other.width)


def stacked(parts: list[Csr], width: int) -> Csr:
    if not parts:
        return Csr(np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), width)
    starts = np.r_[0, np.cumsum(np.concatenate([p.lengths for p in parts]))]
    return Csr(starts, np.concatenate([p.indices for p in parts]), np.concatenate([p.data for p in parts]), width)


def incidence(owner: np.ndarray, height: int, width: int) -> Csr:
    """Rows are the tokens, `owner` the row of each column, in order."""
    return Csr(np.searchsorted(owner, np.arange(height + 1)), np.arange(len(owner)), np.ones(len(owner), np.int64), width)


# ---- tokenizers --------------------------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level entries write bytes: printable Latin-1 ones stand for themselves, the others
    for the code points from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Tokenizers:
    """A byte-level BPE (JSON) and a sentence-piece model, with the bytes of their tokens."""

    a: object
    b: object
    bytes_a: list[bytes]
    bytes_b: list[bytes]

    def __post_init__(self):
        from tiktoken import Encoding

        self.lengths_a, self.lengths_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        special = set(self.a.get_added_tokens_decoder())
        ranks = {x: i for i, x in enumerate(self.bytes_a) if i not in special}
        self.quick = Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)] if texts else []

    def quick_ids_a(self, texts: list[str]) -> list[list[int]]:
        """The same for texts of characters below LATIN, whose classes all Unicode versions agree on."""
        return [self.quick.encode_ordinary(t) for t in texts]

    def ids_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode(texts, num_threads=1) if texts else []

    @property
    def joins_words(self) -> bool:
        """Whether an entry has a space behind something else, so that a token could reach over two units."""
        return any(re.search(f"[^{MARK}]{MARK}", self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))


@cache
def tokenizers(json_model: bytes, piece_model: bytes) -> Tokenizers:
    """From the files' contents, once per worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_buffer(json_model)
    a.encode_special_tokens = True
    alphabet = _byte_alphabet()
    bytes_a = [
        bytes(alphabet[c] for c in entry) if entry and all(c in alphabet for c in entry) else (entry or "").encode()
        for entry in (a.id_to_token(i) for i in range(a.get_vocab_size()))
    ]
    b = SentencePieceProcessor(model_proto=piece_model)
    bytes_b = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace(MARK, " ").encode()
        for i, p in ((i, b.id_to_piece(i)) for i in range(b.get_piece_size()))
    ]
    return Tokenizers(a, b, bytes_a, bytes_b)


#: A space that white space follows. Together with a space at either end: a text that can't be cut at every space.
_RUN = re.compile(r" \s")
#: Cuts that hold for both tokenizers: before the first of some spaces, and before one that a word follows.
_CUT = re.compile(r"(?<=\S)(?= (?!\Z))|(?<=[^\S ])(?= \S)")


def units(text: str) -> list[str]:
    """The units of space + text, each without the space that it begins with."""
    if text[0] != " " and text[-1] != " " and not _RUN.search(text):
        return text.split(" ")
    return [u[1:] for u in _CUT.split(" " + text)]


# ---- blocks of units -----------------------------------------------------------------------------


@dataclass
class Units:
    """Per unit: a token and group count, overlap and shared-group links, text of the groups, pairs of ids (rows of a
    matrix); counts are -1 where the tokens' bytes aren't the unit's."""

    counts: np.ndarray
    groups: list[str]
    pairs: Csr


def _digits(tokens: Tokenizers) -> list[str]:
    """Every id followed by each of its separators: A's by comma and bar, then B's by comma and semicolon."""
    n, m = len(tokens.bytes_a), len(tokens.bytes_b)
    return [f"{i}{s}" for size, marks in ((n, ",|"), (m, ",;")) for s in marks for i in range(size)]


def _spelt(tokens: Tokenizers, words: list[str], quick: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Flat ids of A and of B, and where the units end in bytes; None if some unit's bytes aren't spelt by both. `quick` takes many
    units at a time, which holds for those that begin and end with a word."""
    size = BUNDLE if quick else 1
    bundles = [" ".join(words[i : i + size]) for i in range(0, len(words), size)]
    spaced = [" " + t for t in bundles]
    found_a, found_b = (tokens.quick_ids_a if quick else tokens.ids_a)(spaced), tokens.ids_b(bundles)
    flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (found_a, found_b))
    whole = "".join(spaced).encode()
    for table, ids in ((tokens.bytes_a, flat_a), (tokens.bytes_b, flat_b)):
        if b"".join(map(table.__getitem__, ids.tolist())) != whole:
            return None
    data = np.frombuffer(whole, np.uint8)
    if quick and not any(" " in w for w in words):
        ends = np.r_[np.flatnonzero(data == 32)[1:], len(data)]
    else:
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
    return flat_a, flat_b, ends


def _plain(word: str) -> bool:
    return word != "" and len(word) < 256 and not (word[0].isspace() or word[-1].isspace()) and not _EXOTIC.search(word)


def blocks(tokens: Tokenizers, words: list[str], digits: list[str]) -> Units:
    """Multiply out the blocks of some units (given without their space)."""
    plain = [i for i, w in enumerate(words) if _plain(w)]
    parts = []
    if plain:
        some = [words[i] for i in plain]
        parts = [(plain, some, _spelt(tokens, some, True))]
        if parts[0][2] is None:
            parts, plain = [], []
    marked = set(plain)
    for i, w in enumerate(words):
        if i not in marked:
            parts.append(([i], [w], None if MARK in w else _spelt(tokens, [w], False)))
    spelt = [p for p in parts if p[2] is not None]
    n, width = len(words), len(tokens.bytes_a) * len(tokens.bytes_b)
    order = np.array([i for p in spelt for i in p[0]], np.int64)
    counts, groups = np.full((n, 5), -1, np.int64), [""] * n
    if not spelt:
        return Units(counts, groups, Csr(np.zeros(n + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), width))
    flat_a, flat_b = (np.concatenate([p[2][k] for p in spelt]) for k in (0, 1))
    before = np.r_[0, np.cumsum([p[2][2][-1] for p in spelt])]
    ends = np.concatenate([p[2][2] + x for p, x in zip(spelt, before)])
    found, texts, pairs = _multiplied(tokens, flat_a, flat_b, ends, digits)
    counts[order] = found
    for i, text in zip(order.tolist(), texts):
        groups[i] = text
    rows = np.repeat(order, pairs.lengths)
    return Units(counts, groups, Csr.of(rows, pairs.indices, pairs.data, n, width))


def _multiplied(tokens: Tokenizers, flat_a: np.ndarray, flat_b: np.ndarray, ends: np.ndarray, digits: list[str]) -> tuple[np.ndarray, list[str], Csr]:
    """Counts, texts and pairs of the units that end at the bytes `ends`."""
    size_a, size_b, n = len(tokens.bytes_a), len(tokens.bytes_b), len(ends)
    length_a, length_b = tokens.lengths_a[flat_a], tokens.lengths_b[flat_b]
    end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
    total = int(ends[-1])
    # tokens x bytes; their product: the bytes that two tokens share
    of_a, of_b = (np.repeat(np.arange(len(x)), x) for x in (length_a, length_b))
    bytes_b = Csr(np.arange(total + 1), of_b, np.ones(total, np.int64), len(flat_b))
    overlap = incidence(of_a, len(flat_a), total).times(bytes_b)
    # groups end at the bytes where tokens of both end; units do as well
    is_end = np.zeros(total + 1, np.int8)
    is_end[end_a] += 1
    is_end[end_b] += 1
    cut = np.flatnonzero(is_end == 2)
    numbers = np.cumsum(is_end == 2)
    group_a, group_b = numbers[end_a - 1], numbers[end_b - 1]
    unit = np.zeros(total + 1, np.int64)
    unit[ends[:-1] + 1] = 1
    unit = np.cumsum(unit)
    unit_a, unit_b, unit_g = unit[end_a], unit[end_b], unit[cut]
    in_a, in_b = np.bincount(group_a, minlength=len(cut)), np.bincount(group_b, minlength=len(cut))
    added = lambda at, values: np.diff(np.r_[0, np.cumsum(values)][np.r_[0, np.searchsorted(at, np.arange(n), "right")]])
    n_a, n_b = np.bincount(unit_a, minlength=n), np.bincount(unit_b, minlength=n)
    counts = np.column_stack([n_a, n_b, np.bincount(unit_g, minlength=n), added(unit_g, in_a * in_b), added(unit_a, overlap.lengths)])
    # (unit, id of A) x groups, times groups x ids of B
    key = unit_a * size_a + flat_a
    order = np.argsort(key, kind="stable")
    first = np.r_[True, key[order][1:] != key[order][:-1]]
    rows = key[order][first]
    row_of = np.empty(len(key), np.int64)
    row_of[order] = np.cumsum(first) - 1
    ids_groups = Csr.of(row_of, group_a, np.ones(len(flat_a), np.int64), len(rows), len(cut))
    groups_ids = Csr.of(group_b, flat_b, np.ones(len(flat_b), np.int64), len(cut), size_b)
    product = ids_groups.times(groups_ids)
    owner = rows[np.repeat(np.arange(len(rows)), product.lengths)]
    pairs = Csr.of(owner // size_a, owner % size_a * size_b + product.indices, product.data, n, size_a * size_b)
    # the tokens in the order of their groups, A's before B's
    last_a, last_b = np.r_[group_a[1:] != group_a[:-1], True], np.r_[group_b[1:] != group_b[:-1], True]
    text = np.empty(len(flat_a) + len(flat_b), np.int64)
    text[np.arange(len(flat_a)) + np.r_[0, np.cumsum(in_b)][group_a]] = flat_a + last_a * size_a
    text[np.arange(len(flat_b)) + np.cumsum(in_a)[group_b]] = flat_b + 2 * size_a + last_b * size_b
    pieces = list(map(digits.__getitem__, text.tolist()))
    stops = np.cumsum(n_a + n_b).tolist()
    return counts, ["".join(pieces[a:b])[:-1] for a, b in zip([0, *stops], stops)], pairs


def runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE code points."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= PIECE or i == len(texts) - 1:
            yield start, i + 1
            start, size = i + 1, 0


class Known:
    """The units of a task: looked up where they are known, else multiplied out together."""

    def __init__(self, tokens: Tokenizers):
        self.tokens, self.digits = tokens, _digits(tokens)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.counts, self.groups, self.parts, self.size = [], [], [], 0

    def rows(self, words: list[list[str]]) -> tuple[np.ndarray, list[str], Csr, np.ndarray]:
        """Counts, texts and pairs of all known units; the numbers of the units of `words`, one after the other."""
        if len(self.at) > KNOWN_UNITS or self.size > KNOWN_SIZE:
            self.clear()
        at = self.at
        new = list(set().union(*words) - at.keys())
        for start, end in runs(new):
            made = blocks(self.tokens, new[start:end], self.digits)
            at.update(zip(new[start:end], range(len(at), len(at) + end - start)))
            self.counts.append(made.counts)
            self.groups += made.groups
            self.parts.append(made.pairs)
        self.size += sum(map(len, new))
        width = len(self.tokens.bytes_a) * len(self.tokens.bytes_b)
        if len(self.parts) != 1:
            self.counts, self.parts = [np.concatenate([np.empty((0, 5), np.int64), *self.counts])], [stacked(self.parts, width)]
        return self.counts[0], self.groups, self.parts[0], np.fromiter(map(at.__getitem__, chain.from_iterable(words)), np.int64)


@cache
def known_units(json_model: bytes, piece_model: bytes) -> Known:
    """What a worker process remembers from task to task."""
    return Known(tokenizers(json_model, piece_model))


def aligned(texts: list[str | None], known: Known, wants_groups: bool = False) -> Iterator[tuple]:
    """n_a, n_b, n_groups, n_links, n_overlaps, sha256 (or the text) of the groups, id pairs, times of each text."""
    words = [units(t) if t else [] for t in texts]
    counts, groups, pairs, used = known.rows(words)
    lengths = np.array([len(w) for w in words], np.int64)
    owner, starts = np.repeat(np.arange(len(texts)), lengths), np.r_[0, np.cumsum(lengths)]
    lossless = (lengths > 0) & (np.bincount(owner, counts[used, 0] < 0, len(texts)) == 0)
    totals = np.diff(np.r_[np.zeros((1, 5), np.int64), np.cumsum(counts[used], axis=0)][starts], axis=0)
    kept = lossless[owner]
    documents = Csr.of(owner[kept], used[kept], np.ones(int(kept.sum()), np.int64), len(texts), max(1, pairs.height))
    product = documents.times(pairs)
    for i, ok in enumerate(lossless.tolist()):
        a, b = product.starts[i], product.starts[i + 1]
        if ok:
            text = ";".join(map(groups.__getitem__, used[starts[i] : starts[i + 1]].tolist()))
            told = text if wants_groups else hashlib.sha256(text.encode()).hexdigest()
            yield *totals[i].tolist(), told, product.indices[a:b], product.data[a:b]
        else:
            yield 0, 0, 0, 0, 0, "", product.indices[a:b], product.data[a:b]


# ---- Spark -----------------------------------------------------------------------------------------


def link_rows(docs: DataFrame, json_path: str, piece_path: str, wants_groups: bool = False) -> DataFrame:
    """ROW of every document: counts, digest of the groups (their text with `wants_groups`), and its linked id pairs
    (id of A * size of B's vocabulary + id of B) with how often each is linked in it.

    The driver reads the two files and sends them along. Null and empty texts, and those that the tokens of one side don't
    spell, have zeros, '' and no pairs. Repeated rows and null ids stay rows of their own. A text is tokenised
    whole. `row` is unique if the result is written.
    """
    with open(json_path, "rb") as f, open(piece_path, "rb") as g:
        models = (f.read(), g.read())
    if tokenizers(*models).joins_words:
        raise ValueError("an entry of the second tokenizer reaches over a space between words")
    sent = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        known = known_units(*sent.value)
        for batch in batches:
            texts, keys, ids = (batch.column(c) for c in ("text", "row", "doc_id"))
            texts = texts.to_pylist()
            for start, end in runs(texts):
                found = list(aligned(texts[start:end], known, wants_groups))
                columns = [pa.array([f[c] for f in found], pa.int64()) for c in range(5)]
                offsets = pa.array(np.r_[0, np.cumsum([len(f[6]) for f in found])].astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([f[c] for f in found]), pa.int64())) for c in (6, 7)]
                yield pa.RecordBatch.from_arrays(
                    [keys[start:end], ids[start:end], *columns, pa.array([f[5] for f in found], pa.string()), *lists],
                    [c.split()[0] for c in ROW.split(", ")],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, ROW)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, docs, is_best: in how many rows a pair is linked; whether no pair of the same A id is in more. One row per pair."""
    return rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))


def with_best(counts: DataFrame, size_b: int) -> DataFrame:
    of = F.expr(f"pair div {size_b}")
    best = counts.groupBy(of.alias("a")).agg(F.max("docs").alias("most"))
    return counts.join(best, of == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("is_best"))


def _summed_by_broadcast(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """count_sum and n_best by a sorted copy of the counts in every task."""
    table = counts.orderBy("pair").toArrow()
    sent = rows.sparkSession.sparkContext.broadcast(tuple(table[c].to_numpy() for c in ("pair", "docs", "is_best")))
    kept = [c for c in rows.columns if c not in ("pairs", "times", "row")]
    kinds = dict(rows.dtypes)

    def run(batches):
        pair, docs, best = sent.value
        for batch in batches:
            names = batch.schema.names
            lists, times = batch.column(names.index("pairs")), batch.column(names.index("times")).flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            at = np.searchsorted(pair, lists.flatten().to_numpy(zero_copy_only=False))
            out = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(out[0], owner, times * best[at])
            np.add.at(out[1], owner, times * docs[at])
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(c)) for c in kept), pa.array(out[0]), pa.array(out[1])], [*kept, "n_best", "count_sum"])

    return rows.mapInArrow(run, ", ".join([*(f"{c} {kinds[c]}" for c in kept), "n_best long", "count_sum long"]))


def _summed_by_shuffle(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by joins; adaptive execution splits a pair that many rows hold."""
    each = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    joined = each.join(counts.hint("rebalance"), each["pairs"] == counts["pair"])
    sums = joined.groupBy("row").agg(F.sum(F.when(F.col("is_best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    return rows.drop("pairs", "times").join(sums, "row", "left").drop("row").fillna(0, ["n_best", "count_sum"])


def align(docs: DataFrame, json_path: str, piece_path: str, wants_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups_sha256, n_best, count_sum: one row per document.

    n_overlaps counts token pairs that share a byte, n_links those that share a group; count_sum adds over the links
    how many documents hold their id pair linked, n_best counts the links whose pair is in most documents of all pairs of
    its A id (ties included). See `link_rows` for nulls and the like; other columns are not looked at.
    """
    rows = written(link_rows(docs, json_path, piece_path, wants_groups))
    with open(json_path, "rb") as f, open(piece_path, "rb") as g:
        size_b = len(tokenizers(f.read(), g.read()).bytes_b)
    counts = written(with_best(written(pair_counts(rows)), size_b))
    summed = _summed_by_broadcast if counts.count() <= BROADCAST_PAIRS else _summed_by_shuffle
    return summed(rows, counts)
