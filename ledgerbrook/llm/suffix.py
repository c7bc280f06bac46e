"""Suffix-array dedup by distributed prefix doubling.

Two substrings of `length` bytes are equal if they have the same rank, and ranks of prefixes of 2 h bytes come from sorting pairs of ranks of
h bytes, h apart. Positions drop out as soon as they are unique. The first round ranks sampled prefixes of all texts: every window is
named after the least hash of the prefixes in it (equal windows have equal names), Spark meets the names in buckets,
and windows whose name occurs once are unique. Windows that are left travel to the bucket of their name, consecutive ones as
one string, and are ranked there at growing offsets until they are unique or `length` bytes are compared.
All ranks come from sorting; hashes only choose what is sorted together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import no_null, written

LENGTH = 50
#: Bytes of the prefixes that name a window.
SAMPLE = 24
#: Rounds of doubling.
ROUNDS = 2
#: Bytes that are hashed at a time.
PIECE = 1 << 21


def words_at(data: bytes) -> np.ndarray:
    """The 8 bytes from every position as one number (big-endian order is not needed: numbers are compared for equality and sorted by value)."""
    padded = np.frombuffer(data + bytes(16), np.uint8)
    return np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,))


def runs_of(length: int = LENGTH, sample: int = SAMPLE):
    width = length - sample + 1

    def named(data: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of the windows in the joined texts that end at `ends`."""
        w = words_at(data)
        n = len(data) - sample + 1
        h = w[:n] * np.uint64(0xD6E8FEB86659FD93) + w[8 : n + 8] * np.uint64(0xA0761D6478BD642F) + w[sample - 8 : n + sample - 8] * np.uint64(0xE7037ED1A0B428DB)
        least = chunks.least_of(chunks.mix(h), width)
        valid = np.ones(len(least), bool)
        for e in ends[:-1].tolist():  # windows that would reach into the next text
            valid[max(0, e - length + 1) : e] = False
        return chunks.group_windows(least, valid)

    def find(texts: list[bytes]) -> tuple[chunks.Runs, np.ndarray]:
        firsts, counts, names, owners = [], [], [], []
        offset = start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= PIECE):
                size += len(texts[stop])
                stop += 1
            part = texts[start:stop]
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)))
            data = b"".join(part)
            # a text longer than a piece is hashed in stretches that share all but one byte of a window
            for a in range(0, max(1, len(data) - length + 1), PIECE) if len(part) == 1 else (0,):
                piece = data[a : a + PIECE + length - 1] if len(part) == 1 else data
                if len(piece) >= length:
                    first, count, name = named(piece, ends)
                    firsts.append(first + a + offset)
                    counts.append(count)
                    names.append(chunks.mix(name) >> np.uint64(64 - chunks.NAME_BITS))  # the least hashes are not spread evenly
                    owners.append(np.searchsorted(ends, first + a, "right") + start)
            offset += size
            start = stop
        first, count, name, owner = (np.concatenate(x) if x else np.empty(0, t) for x, t in ((firsts, np.int64), (counts, np.int64), (names, np.uint64), (owners, np.int64)))
        times = 1 - chunks.carried_on(first, count, name, owner).astype(np.int64)
        return chunks.Runs(first, first + count - 1 + length, first, count, name, times), owner

    return find


def _rank(columns: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows of 64-bit columns: sorted by a mixture of the columns, which is checked, else by the columns themselves."""
    if len(columns) == 1:
        mixed = columns[0]
    else:
        mixed = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            mixed = chunks.mix(mixed * np.uint64(3) + c)
    order = np.argsort(mixed)
    value = mixed[order]
    new = np.r_[True, value[1:] != value[:-1]]
    if len(columns) > 1:
        same = np.flatnonzero(~new)
        if any((c[order[same]] != c[order[same - 1]]).any() for c in columns):
            order = np.lexsort(columns)
            new = np.zeros(len(order), bool)
            new[0] = True
            for c in columns:
                new[1:] |= c[order[1:]] != c[order[:-1]]
    rank = np.empty(len(order), np.uint64)
    rank[order] = np.cumsum(new) - 1
    return rank


def double(text: bytes, starts: np.ndarray, length: int = LENGTH, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Windows (indices into `starts`) that are not alone, and their ranks over the whole length."""
    lengths = [length]
    for _ in range(rounds):
        lengths.insert(0, -(-lengths[0] // 2))
    steps = [b - a for a, b in zip(lengths, lengths[1:])]
    offsets = [0]
    for step in reversed(steps):
        offsets = sorted({*offsets, *(o + step for o in offsets)})
    h, w = lengths[0], words_at(text)
    live = np.arange(len(starts))
    columns = [o for o in range(0, max(1, h - 7), 8)]
    if h > 8 and columns[-1] != h - 8:
        columns.append(h - 8)
    at = np.concatenate([starts + o for o in offsets])
    mask = np.uint64((1 << 8 * min(h, 8)) - 1)
    ranks = dict(zip(offsets, np.split(_rank([w[at + c] & mask for c in columns]), len(offsets))))
    for i, step in enumerate(steps):
        wanted = [0]
        for later in reversed(steps[i + 1 :]):
            wanted = sorted({*wanted, *(o + later for o in wanted)})
        pairs = np.concatenate([ranks[o] * np.uint64(1 << 32) + ranks[o + step] for o in wanted])
        rank = _rank([pairs])
        split = np.split(rank, len(wanted))
        # a prefix that no other position has can't have an equal longer one
        alone = np.bincount(rank.astype(np.int64))[split[0].astype(np.int64)] == 1 if len(rank) else np.empty(0, bool)
        keep = np.flatnonzero(~alone)
        live = live[keep]
        ranks = {o: s[keep] for o, s in zip(wanted, split)}
    return live, ranks[0]


def _first_docs(length: int, rounds: int):
    def run(messages: pa.Table) -> pa.Table:
        source, text, lengths, firsts, _ = chunks.unpack(messages)
        ends = np.cumsum(lengths)
        n_windows = lengths - length + 1
        seg = np.repeat(np.arange(len(lengths)), n_windows)
        head = np.cumsum(n_windows) - n_windows
        offset = np.arange(len(seg)) - head[seg]
        live, rank = double(text, (ends - lengths)[seg] + offset, length, rounds)
        if not len(live):
            return chunks.replies(messages, source, live, live, live)
        order = np.argsort(rank)
        value, doc = rank[order], firsts[seg[live]][order]
        heads = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        least = np.empty(len(live), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(doc, heads), np.diff(np.r_[heads, len(order)]))
        earlier = least < firsts[seg[live]]
        at = live[earlier]
        return chunks.replies(messages, source, seg[at], offset[at], least[earlier])

    return run


RESULT = "key binary, first long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:int,end:int>>"


def _apply(length: int):
    """Mark the windows that an earlier document has, and cut the bytes they cover."""

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        keys, data, first, _ = chunks.in_order(texts)
        ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
        change = np.zeros((int(ends[-1]) if len(ends) else 0) + 1, np.int32)
        for doc, at, segment, lengths, firsts, _, answer in chunks.told_windows(told):
            own = first[doc]
            whole = firsts[segment] < own
            np.add.at(change, at[whole], 1)
            np.add.at(change, at[whole] + lengths[segment[whole]], -1)
            if answer is not None:
                occ, offset, n, least = chunks.to_occurrences(segment, answer)
                earlier = least < own[occ]
                begin = at[occ[earlier]] + offset[earlier]
                np.add.at(change, begin, 1)
                np.add.at(change, begin + n[earlier] - 1 + length, -1)
        covered = np.cumsum(change[:-1], dtype=np.int32) > 0
        out: list[tuple] = []
        start = 0
        for key, text, f, end in zip(keys, data, first.tolist(), ends.tolist()):
            edge = np.flatnonzero(np.diff(np.r_[False, covered[start:end], False])).tolist()
            spans, kept, last = [], hashlib.sha256(), 0
            for a, b in zip(edge[::2], edge[1::2]):
                spans.append({"start": a, "end": b})
                kept.update(text[last:a])
                last = b
            kept.update(text[last:])
            out.append((key, f, sum(x["end"] - x["start"] for x in spans), len(spans), kept.hexdigest(), spans))
            start = end
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["key", "first", "n_removed", "n_spans", "kept_sha256", "removed"])

    return run


def dedup(docs: DataFrame, length: int = LENGTH, sample: int = SAMPLE, rounds: int = ROUNDS, heavy: int = chunks.HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (array of struct(start, end), byte offsets): one row per row of `docs`.

    A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller doc_id; strings are judged on the
    input and never cross documents. Null texts are empty; a null doc_id counts as larger than any other; rows of one doc_id
    don't remove from one another. An empty table gives no row; other columns are not looked at.
    """
    if not 16 <= sample <= length:
        raise ValueError("a sampled prefix has 16 bytes at least and `length` at most")
    table, n = chunks.distinct_texts(docs)
    find = runs_of(length, sample)
    names = chunks.shared_names(table, n, find, heavy)
    sent = written(chunks.segments(
        table, names, 4 * n, find, lambda data, begin, end: data[begin:end],
        lambda text: [text[i : i + length] for i in range(len(text) - length + 1)],
    ))
    answers = chunks.asked(sent, 4 * n, _first_docs(length, rounds))
    result = table.groupBy("chunk").cogroup(chunks.told(sent, answers).groupBy("chunk")).applyInArrow(_apply(length), RESULT)
    text = no_null("text")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("of"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.when(F.octet_length(text) < length, F.sha2(text.cast("binary"), 256)).alias("whole"),
    )
    leads = F.coalesce("doc_id", F.lit((1 << 63) - 1)) == F.col("first")
    copied = F.when(F.col("n_bytes") >= length, F.col("n_bytes")).otherwise(0)  # all of a copy has been seen before
    spans = F.when(F.col("n_bytes") >= length, F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end"))))
    return rows.join(result, F.col("of") == F.col("key")).select(
        "doc_id", "n_bytes", F.when(leads, F.col("n_removed")).otherwise(copied).cast("long").alias("n_removed"),
        F.when(leads, F.col("n_spans")).otherwise((F.col("n_bytes") >= length).cast("long")).alias("n_spans"),
        F.when(leads, F.col("kept_sha256")).otherwise(F.coalesce("whole", F.sha2(F.lit(b""), 256))).alias("kept_sha256"),
        F.when(leads, F.col("removed")).otherwise(F.coalesce(spans, F.array().cast("array<struct<start:int,end:int>>"))).alias("removed"),
    )
