"""Substring dedup by super-k-mer partitioning.

Consecutive windows of words that share a minimiser (the least hash of the shorter word sequences in a window) travel
as one packed string, a super-k-mer, to the bucket of the minimiser. Equal windows have equal minimisers, so they meet
in one bucket, where sorting the windows counts each exactly. Minimisers that occur once in the corpus are
counted first and not sent, as none of their windows can occur twice.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import no_null, written

WINDOW = 35
#: Words of a minimiser.
MINIMISER = 8

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words in UTF-8 bytes; white space separates."""
    letter = ~_SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[False, letter, False]))
    return edge[::2], edge[1::2]


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, block: int = 1 << 20) -> np.ndarray:
    """A hash of each word, added up over blocks of bytes, as a word may be as long as its text."""
    total = np.zeros(len(begin), np.uint64)
    for a in range(0, len(data), block):
        some = data[a : a + block]
        i, j = np.searchsorted(end, a, "right"), np.searchsorted(begin, a + len(some))
        if i < j:
            starts = np.maximum(begin[i:j] - a, 0)
            number = np.cumsum(np.bincount(starts, minlength=len(some))) - 1
            place = np.arange(a, a + len(some)) - begin[i + np.maximum(number, 0)]
            mixed = chunks.mix((some.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F) + place.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
            total[i:j] += np.add.reduceat(np.where(_SPACE[some], np.uint64(0), mixed), starts)
    return chunks.mix(total + (end - begin).astype(np.uint64))


def stretches(text: bytes, window: int, piece: int):
    """Offset and end of stretches of a text of about `piece` bytes, whole words each, so that every window is in one of them whole
    and the windows of the stretches are different ones; the first word and the words of a stretch, which overlap by window - 1."""
    data = np.frombuffer(text, np.uint8)
    at = word = 0
    reach = piece
    while True:
        stop = at + reach
        while stop < len(data) and not (space := _SPACE[data[stop : stop + 65536]]).any():
            stop += 65536
        stop = stop + int(space.argmax()) if stop < len(data) else len(data)
        begin, end = word_bounds(data[at:stop])
        if stop == len(data):
            yield at, stop, word, begin, end
            return
        if len(begin) < 2 * window:
            reach *= 2
            continue
        yield at, stop, word, begin, end
        new = len(begin) - window + 1
        at, word, reach = at + int(begin[new]), word + new, piece


def runs_of(window: int = WINDOW, minimiser: int = MINIMISER, piece: int = 1 << 20):
    """Runs of a chunk: begin and end are bytes of the joined texts; first is the first window's number (words of the chunk)."""
    width = window - minimiser + 1

    def named(data: np.ndarray, begin: np.ndarray, end: np.ndarray, own: np.ndarray) -> tuple | None:
        """Begin, end, first window, count, name, times and text of the runs in the words of `data`."""
        if len(begin) < window:
            return None
        w = word_hashes(data, begin, end)
        h = np.zeros(len(w) - minimiser + 1, np.uint64)
        for k in range(minimiser):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[k : k + len(h)]
        h = chunks.mix(h)
        least = chunks.least_of(h, width)
        valid = own[: len(least)] == own[window - 1 :]
        first, count, name = chunks.group_windows(least, valid)
        # a run with its minimiser in two places may have equal windows
        leftmost = first + h[first[:, None] + np.arange(width)].argmin(axis=1)
        last = first + count - 1
        rightmost = last + width - 1 - h[last[:, None] + np.arange(width - 1, -1, -1)].argmin(axis=1)
        times = 1 + (leftmost < rightmost)
        return begin[first], end[first + count + window - 2], first, count, chunks.mix(name) >> np.uint64(64 - chunks.NAME_BITS), times, own[first]

    def find(texts: list[bytes]) -> tuple[chunks.Runs, np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in range(7)]

        def add(found: tuple | None, offset: int, words: int, start: int) -> None:
            if found is not None:
                begin, end, first, count, name, times, text_of = found
                # in the joined texts there are no line breaks between them
                values = (begin - text_of + offset, end - text_of + offset, first + words, count, name, times, text_of + start)
                for column, value in zip(out, values):
                    column.append(value)

        offset = words_before = start = 0
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= piece):
                size += len(texts[stop])
                stop += 1
            part = texts[start:stop]
            if size > piece:  # one long text
                data, words = np.frombuffer(part[0], np.uint8), 0
                for at, to, words, begin, end in stretches(part[0], window, piece):
                    add(named(data[at:to], begin, end, np.zeros(len(begin), np.int64)), offset + at, words_before + words, start)
                words += len(begin)
            else:  # a line break keeps words of two texts apart
                data = np.frombuffer(b"\n".join(part), np.uint8)
                text_end = np.cumsum([len(t) + 1 for t in part])
                begin, end = word_bounds(data)
                add(named(data, begin, end, np.searchsorted(text_end, begin, "right")), offset, words_before, start)
                words = len(begin)
            offset += size
            words_before += words
            start = stop
        begin, end, first, count, name, times, owner = [np.concatenate(c) if c else np.empty(0, t) for c, t in zip(out, (np.int64, np.int64, np.int64, np.int64, np.uint64, np.int64, np.int64))]
        times = np.where(chunks.carried_on(first, count, name, owner), 0, times)
        return chunks.Runs(begin, end, first, count, name, times), owner

    return find


def pack(data: bytes, begin: int, end: int) -> bytes:
    """A super-k-mer: its words joined by one space, closed by a line break (which no word has)."""
    return b" ".join(data[begin:end].split()) + b"\n"


def _counted(window: int):
    """Answer with the windows that occur more than once; a window's value is 1."""

    def run(messages: pa.Table) -> pa.Table:
        source, text, lengths, _, times = chunks.unpack(messages)
        windows: list[tuple[bytes, int, int]] = []
        start = 0
        for number, size in enumerate(lengths.tolist()):
            packed = text[start : start + size - 1]
            start += size
            bounds = [-1, *np.flatnonzero(np.frombuffer(packed, np.uint8) == 0x20).tolist(), len(packed)]
            windows += [(packed[a + 1 : b], number, at) for at, (a, b) in enumerate(zip(bounds, bounds[window:]))]
        windows.sort()
        seg, offset, i = [], [], 0
        many = (times > 1).tolist()
        while i < len(windows):
            j = i + 1
            words = windows[i][0]
            while j < len(windows) and windows[j][0] == words:
                j += 1
            if j > i + 1 or many[windows[i][1]]:
                for _, number, at in windows[i:j]:
                    seg.append(number)
                    offset.append(at)
            i = j
        seg, offset = np.array(seg, dtype=np.int64), np.array(offset, dtype=np.int64)
        order = np.lexsort((offset, seg))
        return chunks.replies(messages, source, seg[order], offset[order], np.ones(len(order), np.int64))

    return run


RESULT = "key binary, copies long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start:int,end:int>>"


def _apply(window: int):
    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        keys, data, _, copies = chunks.in_order(texts)
        bounds = [word_bounds(np.frombuffer(t, np.uint8)) for t in data]
        ends = np.cumsum([len(b) for b, _ in bounds], dtype=np.int64)
        change = np.zeros((int(ends[-1]) if len(ends) else 0) + 1, np.int32)
        for _, at, segment, _, _, _, answer in chunks.told_windows(told):
            if answer is not None:
                occ, offset, n, _ = chunks.to_occurrences(segment, answer)
                np.add.at(change, at[occ] + offset, 1)
                np.add.at(change, at[occ] + offset + n - 1 + window, -1)
        covered = np.cumsum(change[:-1], dtype=np.int32) > 0
        out: list[tuple] = []
        start = 0
        for key, text, n, (begin, end), stop in zip(keys, data, copies.tolist(), bounds, ends.tolist()):
            gone = covered[start:stop] | (n > 1 and len(begin) >= window)
            edge = np.flatnonzero(np.diff(np.r_[False, gone, False])).tolist()
            kept, left, right = hashlib.sha256(), begin[~gone], end[~gone]
            for i in range(0, len(left), 65536):
                words = zip(left[i : i + 65536].tolist(), right[i : i + 65536].tolist())
                kept.update((b" " if i else b"") + b" ".join(text[a:b] for a, b in words))
            out.append((key, n, len(begin), int(gone.sum()), kept.hexdigest(), [{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2])]))
            start = stop
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], ["key", "copies", "n_words", "n_removed", "kept_sha256", "removed"])

    return run


def dedup(docs: DataFrame, window: int = WINDOW, minimiser: int = MINIMISER, heavy: int = chunks.HEAVY) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, removed (array of struct(start, end), word offsets): one row per row of `docs`.

    A word goes if a window of `window` words that covers it has the word sequence of a window that starts anywhere else, in the same
    text or another row; windows are judged on the input and never cross documents. Null texts have no words, null ids
    are kept, repeated rows are places of their own, an empty table gives no row, other columns are not looked at.
    """
    if not 1 <= minimiser <= window:
        raise ValueError("a minimiser has at least one word and `window` at most")
    table, n = chunks.distinct_texts(docs)
    find = runs_of(window, minimiser)
    names = chunks.shared_names(table, n, find, heavy)

    def windows(packed: bytes) -> list[bytes]:
        words = packed[:-1].split(b" ")
        return [b" ".join(words[i : i + window]) + b"\n" for i in range(len(words) - window + 1)]

    sent = written(chunks.segments(table, names, 4 * n, find, pack, windows))
    answers = chunks.asked(sent, 4 * n, _counted(window))
    result = table.groupBy("chunk").cogroup(chunks.told(sent, answers).groupBy("chunk")).applyInArrow(_apply(window), RESULT)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(no_null("text").cast("binary"))).alias("of"))
    return rows.join(result, F.col("of") == F.col("key")).select("doc_id", "n_words", "n_removed", "kept_sha256", "removed")
