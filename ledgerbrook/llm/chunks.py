"""Distinct texts in chunks, and messages between chunks and buckets: the frame of both operators on repeated passages.

Equal texts are one text (each task folds its own copies before the shuffle). Distinct texts are dealt to chunks of bounded
size, stored bucketed by chunk, so that later steps meet a chunk's texts without shuffling them again. What chunks
send to buckets is pre-aggregated per chunk, so a passage in a third of all documents reaches its bucket at most
once per chunk. A name that is very frequent in ever different surroundings would still make a large bucket;
its windows are sent one by one to buckets by a hash of the window, which spreads them over all buckets.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_null, parts, shared_folder, text_bytes

#: A name with so many occurrences is heavy: its windows go to buckets of their own, by their own text, one by one.
HEAVY = 16384
#: A run ends after so many windows, so a text that repeats itself travels as many equal runs instead of one as long as itself.
LONGEST = 4096
#: Bits of the names that runs of windows are counted by before anything else is sent.
NAME_BITS = 48


@dataclass
class Runs:
    """Windows of a chunk, consecutive ones with the same least hash together: start and end of the text of a run, its first
    window and number of windows (in units), the name."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray
    count: np.ndarray
    name: np.ndarray
    times: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` consecutive values, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(values) - width + 1], out[width - have :])
    return out


def group_windows(least: np.ndarray, valid: np.ndarray, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number and name of the runs of valid consecutive windows with equal least value, of `longest` windows at most.

    Where a run is cut makes no difference to what is found: both pieces keep the name.
    """
    at = np.flatnonzero(valid)
    if not len(at):
        return at, at, np.empty(0, np.uint64)
    value = least[at]
    new = np.r_[True, (at[1:] != at[:-1] + 1) | (value[1:] != value[:-1])]
    heads = np.flatnonzero(new)
    if len(at) > longest and np.diff(np.r_[heads, len(at)]).max() > longest:
        place = np.arange(len(at)) - np.repeat(heads, np.diff(np.r_[heads, len(at)]))
        heads = np.flatnonzero(place % longest == 0)
    return at[heads], np.diff(np.r_[heads, len(at)]), value[heads]


def carried_on(first: np.ndarray, count: np.ndarray, name: np.ndarray, owner: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Which runs go on with one that was ended for its length. They don't count as occurrences of the name: one long run is no
    heavy name, and the piece before them has counted."""
    on = (count[:-1] == longest) & (first[1:] == first[:-1] + longest) & (name[1:] == name[:-1]) & (owner[1:] == owner[:-1])
    return np.r_[False, on] if len(first) else np.empty(0, bool)


def squeeze(a: np.ndarray) -> bytes:
    """Integers by byte planes, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes())


def expand(b: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)


def squeeze_sorted(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=np.uint64(0)))


def expand_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(expand(b, np.uint64), dtype=np.uint64)


def bucket_of(names: np.ndarray, n: int) -> np.ndarray:
    """Even ranges of the names, so sorted names have sorted buckets."""
    return ((names >> np.uint64(NAME_BITS - 32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def distinct_texts(docs: DataFrame) -> tuple[DataFrame, int]:
    """A stored table of chunk, text, first (smallest doc_id), copies, bucketed by chunk; and the number of chunks."""
    spark = docs.sparkSession
    n = max(parts(text_bytes(docs), 8 << 20), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per distinct text and task; memory: a digest, an id and a count for each, and the batch."""
        seen: dict[bytes, list[int]] = {}
        for b in batches:
            texts, ids, keep = b["text"].to_pylist(), b["doc_id"].to_pylist(), []
            for i, (text, doc) in enumerate(zip(texts, ids)):
                key = hashlib.md5(text.encode()).digest()
                if key in seen:
                    seen[key][0] = min(seen[key][0], doc)
                    seen[key][1] += 1
                    seen[key][2] |= 1
                else:
                    seen[key] = [doc, 1, 0]
                    keep.append((i, key, doc))
            yield pa.record_batch(
                [pa.array([int.from_bytes(k[:6], "big") % n for _, k, _ in keep], pa.int32()), pa.array([k for _, k, _ in keep], pa.binary()),
                 b["text"].take(pa.array([i for i, _, _ in keep], pa.int64())), pa.array([d for _, _, d in keep], pa.int64()), pa.array([1] * len(keep), pa.int64())],
                ["chunk", "key", "text", "first", "copies"],
            )
        more = [(k, v) for k, v in seen.items() if v[2]]
        yield pa.record_batch(
            [pa.array([int.from_bytes(k[:6], "big") % n for k, _ in more], pa.int32()), pa.array([k for k, _ in more], pa.binary()),
             pa.array([None] * len(more), pa.string()), pa.array([v[0] for _, v in more], pa.int64()), pa.array([v[1] - 1 for _, v in more], pa.int64())],
            ["chunk", "key", "text", "first", "copies"],
        )

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc_id"), no_null("text").alias("text")
    ).mapInArrow(fold, "chunk int, key binary, text string, first long, copies long")
    folded = rows.repartition(n, "chunk").groupBy("chunk", "key").agg(
        F.max("text").alias("text"), F.min("first").alias("first"), F.sum("copies").alias("copies")
    )
    name = f"distinct_texts_{uuid.uuid4().hex}"
    folded.select("chunk", "key", "text", "first", "copies").write.format("parquet").option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}").bucketBy(n, "chunk").saveAsTable(name)
    return spark.table(name), n


def in_order(texts: pa.Table) -> tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]:
    """Keys, encoded texts, first ids and copies of a chunk, ordered by key."""
    keys = texts["key"].to_pylist()
    order = sorted(range(len(keys)), key=keys.__getitem__)
    text, first, copies = texts["text"].to_pylist(), texts["first"].to_numpy(), texts["copies"].to_numpy()
    return [keys[i] for i in order], [text[i].encode() for i in order], first[order], copies[order]


NAMES = "chunk int, bucket int, names binary, counts binary"
SEGMENTS = "chunk int, bucket int, segments binary, lengths binary, firsts binary, times binary, occ_segment binary, occ_doc binary, occ_first binary"


def shared_names(table: DataFrame, n: int, runs_of, heavy: int = HEAVY) -> DataFrame:
    """chunk, names, heavy: the names that occur in two runs of the corpus at least, told to every chunk that has them, and which of
    them occur `heavy` times.

    runs_of(texts: list of bytes) gives the Runs of a chunk and the number of the text of each.
    """

    def send(texts: pa.Table) -> pa.Table:
        _, data, _, copies = in_order(texts)
        runs, owner = runs_of(data)
        names, inverse = np.unique(runs.name, return_inverse=True)
        counts = np.minimum(np.bincount(inverse, copies[owner] * runs.times, len(names)), 1 << 31).astype(np.uint32)
        cuts = np.flatnonzero(np.diff(bucket_of(names, n), prepend=-1))
        out = [(int(bucket_of(names[a : a + 1], n)[0]), squeeze_sorted(names[a:b]), squeeze(counts[a:b])) for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(names)])]
        return pa.table([pa.array([texts["chunk"][0].as_py()] * len(out), pa.int32()), *(pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary())))], ["chunk", "bucket", "names", "counts"])

    def meet(messages: pa.Table) -> pa.Table:
        chunk = messages["chunk"].to_pylist()
        names = [expand_sorted(x) for x in messages["names"].to_pylist()]
        counts = np.concatenate([expand(x, np.uint32) for x in messages["counts"].to_pylist()])
        every = np.concatenate(names)
        order = np.argsort(every)
        value = every[order]
        head = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        total = np.add.reduceat(counts[order].astype(np.int64), head)
        times = np.empty(len(every), np.int64)
        times[order] = np.repeat(total, np.diff(np.r_[head, len(value)]))
        out, at = [], 0
        for c, x in zip(chunk, names):
            mine = times[at : at + len(x)]
            at += len(x)
            keep = mine >= 2
            if keep.any():
                out.append((c, squeeze_sorted(x[keep]), squeeze((mine[keep] >= heavy).view(np.uint8))))
        return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["chunk", "names", "heavy"])

    return (
        table.groupBy("chunk").applyInArrow(send, NAMES)
        .repartition(n, "bucket").groupBy("bucket").applyInArrow(meet, "chunk int, names binary, heavy binary")
    )


def segments(table: DataFrame, names: DataFrame, n: int, runs_of, pack, windows) -> DataFrame:
    """SEGMENTS: the runs with a shared name, each distinct text of a run once per chunk and bucket, with the smallest doc_id and the number
    of rows that have it in the chunk; and where in the chunk each occurs (text number and first window).

    pack(data: bytes of the chunk, begin, end) gives the text of a run that travels; windows(text of a run) its windows, as texts of
    runs of one window each.
    """

    def send(texts: pa.Table, told: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], t) for t in (pa.int32(), pa.int32(), *[pa.binary()] * 7)], [c.split()[0] for c in SEGMENTS.split(", ")])
        if not len(texts) or not len(told):
            return none
        shared = np.concatenate([expand_sorted(x) for x in told["names"].to_pylist()])
        heavy = np.concatenate([expand(x, np.uint8) for x in told["heavy"].to_pylist()])
        order = np.argsort(shared)
        shared, heavy = shared[order], heavy[order].astype(bool)
        _, data, first, copies = in_order(texts)
        runs, owner = runs_of(data)
        place = np.minimum(np.searchsorted(shared, runs.name), len(shared) - 1)
        keep = np.flatnonzero(shared[place] == runs.name)
        if not len(keep):
            return none
        joined = b"".join(data)
        known: dict[bytes, int] = {}  # every text that travels, once
        found = [pack(joined, a, b) for a, b in zip(runs.begin[keep].tolist(), runs.end[keep].tolist())]
        bucket, own, at_first = bucket_of(runs.name[keep], n), owner[keep], runs.first[keep]
        apart = heavy[place[keep]]
        stay = np.flatnonzero(~apart)
        text_of = [np.array([known.setdefault(found[i], len(known)) for i in stay.tolist()], dtype=np.uint32)]
        bucket_at, own_at, first_at = [bucket[stay]], [own[stay]], [at_first[stay]]
        singles: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}  # windows of a run and their buckets; equal runs share them
        for i in np.flatnonzero(apart).tolist():
            if found[i] not in singles:
                single = windows(found[i])
                digests = [int.from_bytes(hashlib.blake2b(x, digest_size=6).digest(), "big") for x in single]
                numbers = np.array([known.setdefault(x, len(known)) for x in single], dtype=np.uint32)
                singles[found[i]] = numbers, bucket_of(np.array(digests, dtype=np.uint64), n)
            numbers, to = singles[found[i]]
            text_of.append(numbers)
            bucket_at.append(to)
            own_at.append(np.full(len(to), own[i]))
            first_at.append(at_first[i] + np.arange(len(to)))
        every = list(known)
        text_of, bucket, own, at_first = (np.concatenate(x) for x in (text_of, bucket_at, own_at, first_at))
        order = np.argsort(bucket, kind="stable")
        text_of, bucket, own, at_first = text_of[order], bucket[order], own[order], at_first[order]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        out = []
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
            used, number = np.unique(text_of[a:b], return_inverse=True)
            docs = own[a:b]
            firsts = np.full(len(used), np.iinfo(np.int64).max)
            np.minimum.at(firsts, number, first[docs])
            times = np.bincount(number, copies[docs], len(used)).astype(np.int64)
            sent = [every[i] for i in used.tolist()]
            out.append((
                int(bucket[a]), zstandard.ZstdCompressor(level=3).compress(b"".join(sent)), squeeze(np.fromiter(map(len, sent), np.uint32, len(sent))),
                squeeze(firsts), squeeze(times), squeeze(number.astype(np.uint32)), squeeze(docs.astype(np.uint32)), squeeze(at_first[a:b].astype(np.int64)),
            ))
        return pa.table([pa.array([texts["chunk"][0].as_py()] * len(out), pa.int32()), *(pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), *[pa.binary()] * 7)))], none.column_names)

    return table.groupBy("chunk").cogroup(names.groupBy("chunk")).applyInArrow(send, SEGMENTS)


def unpack(messages: pa.Table) -> tuple[np.ndarray, bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All segments of a bucket: message number of each, the texts one after the other, lengths, firsts, times."""
    lengths = [expand(x, np.uint32) for x in messages["lengths"].to_pylist()]
    source = np.repeat(np.arange(len(lengths)), [len(x) for x in lengths])
    text = b"".join(zstandard.ZstdDecompressor().decompress(x) for x in messages["segments"].to_pylist())
    firsts = np.concatenate([expand(x, np.int64) for x in messages["firsts"].to_pylist()])
    times = np.concatenate([expand(x, np.int64) for x in messages["times"].to_pylist()])
    return source, text, np.concatenate(lengths).astype(np.int64), firsts, times


REPLIES = "chunk int, bucket int, segment binary, offset binary, n binary, doc binary"


def replies(messages: pa.Table, source: np.ndarray, seg: np.ndarray, offset: np.ndarray, doc: np.ndarray) -> pa.Table:
    """Rows of REPLIES from windows (segment over the whole bucket, offset, value), ordered; equal neighbours are one entry."""
    names = [c.split()[0] for c in REPLIES.split(", ")]
    kinds = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
    if not len(seg):
        return pa.table([pa.array([], t) for t in kinds], names)
    new = np.flatnonzero(np.r_[True, (seg[1:] != seg[:-1]) | (offset[1:] != offset[:-1] + 1) | (doc[1:] != doc[:-1])])
    n = np.diff(np.r_[new, len(seg)])
    seg, offset, doc = seg[new], offset[new], doc[new]
    first_of = np.searchsorted(source, np.arange(len(messages)))
    of = source[seg]
    out = []
    for m in np.unique(of).tolist():
        at = np.flatnonzero(of == m) if len(messages) < 2 else slice(*np.searchsorted(of, [m, m + 1]))
        out.append((messages["chunk"][m].as_py(), messages["bucket"][m].as_py(), squeeze((seg[at] - first_of[m]).astype(np.uint32)), squeeze(offset[at].astype(np.uint32)), squeeze(n[at].astype(np.uint32)), squeeze(doc[at].astype(np.int64))))
    return pa.table([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names)


_OCCURRENCES = ("lengths", "firsts", "times", "occ_segment", "occ_doc", "occ_first")
_ANSWERS = ("segment", "offset", "n", "doc")


def asked(sent: DataFrame, n: int, answer) -> DataFrame:
    """REPLIES of the buckets; answer(messages) sees all messages of one bucket."""
    columns = ("chunk", "bucket", "segments", "lengths", "firsts", "times")
    return sent.select(*columns).repartition(n, "bucket").groupBy("bucket").applyInArrow(answer, REPLIES)


def told(sent: DataFrame, answers: DataFrame) -> DataFrame:
    """What a chunk needs to mark its windows: its own occurrences and the answers, in one table."""
    null = lambda names: [F.lit(None).cast("binary").alias(x) for x in names]
    own = sent.select("chunk", "bucket", *_OCCURRENCES, *null(_ANSWERS))
    return own.unionByName(answers.select("chunk", "bucket", *null(_OCCURRENCES), *_ANSWERS))


def told_windows(rows: pa.Table):
    """Per message of a chunk: text number, first window and segment of its occurrences; lengths, firsts and times of its segments; the
    answer as arrays segment, offset, n, doc (None without any)."""
    columns = {c: rows[c].to_pylist() for c in rows.column_names}
    answer_at = {b: i for i, b in enumerate(columns["bucket"]) if columns["segment"][i] is not None}
    for m, bucket in enumerate(columns["bucket"]):
        if columns["segment"][m] is not None:
            continue
        get = lambda c, t: expand(columns[c][m], t).astype(np.int64)  # noqa: E731, B023
        i = answer_at.get(bucket)
        kinds = zip(_ANSWERS, (np.uint32, np.uint32, np.uint32, np.int64))
        answer = None if i is None else tuple(expand(columns[c][i], t).astype(np.int64) for c, t in kinds)
        yield (
            get("occ_doc", np.uint32), get("occ_first", np.int64), get("occ_segment", np.uint32),
            get("lengths", np.uint32), get("firsts", np.int64), get("times", np.int64), answer,
        )


def to_occurrences(segment: np.ndarray, answer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every answer for every occurrence of its segment: occurrence, offset, n, doc."""
    seg, offset, n, doc = answer
    order = np.argsort(segment, kind="stable")
    low, high = np.searchsorted(segment[order], seg, "left"), np.searchsorted(segment[order], seg, "right")
    times = high - low
    ends = np.cumsum(times)
    at = np.repeat(low - np.r_[0, ends[:-1]], times) + np.arange(ends[-1] if len(ends) else 0)
    each = np.repeat(np.arange(len(seg)), times)
    return order[at], offset[each], n[each], doc[each]
