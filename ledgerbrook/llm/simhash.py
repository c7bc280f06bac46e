"""SimHash near-duplicates by bit-sliced comparison.

A fingerprint bit is set if it is set in more than half of the shingle hashes. Fingerprints are compared within
buckets: 64 bits in four blocks, and at a distance of 2 two blocks at least are equal, so each pair of blocks is a
bucket key and no link is missed; a crowded bucket is split further, by blocks of its remaining bits. In a bucket, distances
are counted for many pairs at once: bit planes are stored vertically (one word holds one bit of 64 fingerprints), the planes
moved by a lag are those of the partners, carry-save counters add up plane after plane, and a
block of pairs is abandoned once all of its pairs exceed the radius. A bucket gives only links that span its
components. Components grow by large-star and small-star steps in Spark.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_null, written

SHINGLE = 3
RADIUS = 2
SEED = 42
BITS = 64
#: Words of 64 pairs that are compared side by side.
LANES = 4096
#: A bucket of more rows is split further.
CROWDED = 512

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str, size: int = SHINGLE) -> list[int]:
    """XXH64 of the word shingles, repeats included; of the whole sequence if there are fewer words; none without words."""
    found = _WORD.findall(text.encode().translate(_UPPER))
    if not found:
        return []
    line, digest = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    if len(found) <= size:
        return [digest(line, SEED)]
    starts = np.r_[0, ends[:-size] + 1]
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[size - 1 :].tolist())]


def fingerprint(hashes: list[int]) -> int:
    """Bit set in over half of the hashes; 0 without any."""
    if not hashes:
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(np.array(hashes[at : at + (1 << 14)], dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row; null texts are empty. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [fingerprint(shingle_hashes(t, shingle)) for t in b["text"].to_pylist()]
            yield pa.record_batch([b["doc_id"], pa.array(np.array(values, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_null("text").alias("text")).mapInArrow(run, "doc_id long, fp long")


def planes(fp: np.ndarray) -> np.ndarray:
    """[bit, word]: bit k of fingerprints 64 w .. 64 w + 63 in word w of row k; one word more than needed."""
    out = np.zeros((BITS, -(-len(fp) // 64) + 1), np.uint64)
    for at in range(0, len(fp), LANES):
        some = fp[at : at + LANES]
        bits = np.zeros((-(-len(some) // 64) * 64, BITS), np.uint8)
        bits[: len(some)] = np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        words = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")
        out[:, at // 64 : at // 64 + words.shape[1]] = words
    return out


def near(stored: np.ndarray, rows: np.ndarray, lag: int, radius: int = RADIUS) -> np.ndarray:
    """Those of the rows (ascending) that differ from the row `lag` behind them in at most `radius` bits, by the stored bit planes and
    carry-save counters. 64 pairs are one word, whose partners are the same planes moved by the lag."""
    n_counters, everything = max(1, radius.bit_length()), ~np.uint64(0)
    words, place = np.unique(rows >> 6, return_inverse=True)
    asked = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(asked, place, np.uint64(1) << (rows & 63).astype(np.uint64))
    whole, rest = lag >> 6, np.uint64(lag & 63)
    close = np.empty(len(words), np.uint64)
    for at in range(0, len(words), LANES):
        w = words[at : at + LANES]
        over = ~asked[at : at + LANES]
        counters = [np.zeros(len(w), np.uint64) for _ in range(n_counters)]
        for k in range(BITS):
            moved = stored[k, w + whole] >> rest
            if rest:
                moved |= stored[k, w + whole + 1] << (np.uint64(64) - rest)
            carry = stored[k, w] ^ moved
            for c in range(n_counters):
                counters[c], carry = counters[c] ^ carry, counters[c] & carry
            over |= carry
            if k % 8 == 7:
                if radius + 1 < 1 << n_counters:  # the counters hold more than the radius: compare them with it
                    above, equal = np.zeros_like(over), np.full_like(over, everything)
                    for c in range(n_counters - 1, -1, -1):
                        want = everything if radius >> c & 1 else np.uint64(0)
                        above |= equal & counters[c] & ~want
                        equal &= ~(counters[c] ^ want)
                    # a counter that is over now may run over later, never come back unseen
                    over |= above
                if (over == everything).all():
                    break
        close[at : at + LANES] = ~over
    return rows[(close[place] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(bool)]


def within(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Which of the pairs a[i], b[i] differ in at most `radius` bits: one row of all a, then all b, compared at that lag."""
    out = np.zeros(len(a), bool)
    out[near(planes(np.r_[a, b]), np.arange(len(a)), len(a), radius)] = True
    return out


def buckets(key: np.ndarray, fp: np.ndarray, free: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, rows): row numbers in order of their bucket. A bucket of more than CROWDED rows is split by its free bits (the ones that its
    rows need not share) in three blocks: within a radius of 2 one of them is equal, so the three sets of
    smaller buckets hold every link; and so on until buckets are small or no free bits are left."""
    work = [(key, np.arange(len(fp)), free)]
    while work:
        bucket, rows, bits = work.pop()
        size = np.diff(np.r_[np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(bucket)]) if len(bucket) else np.empty(0, np.int64)
        crowded = np.repeat(size > CROWDED, size) & (len(bits) >= 3)
        if not crowded.all():
            yield bucket[~crowded], rows[~crowded]
        if crowded.any():
            of, those = np.cumsum(np.r_[True, bucket[crowded][1:] != bucket[crowded][:-1]]), rows[crowded]
            for block in np.array_split(bits, 3):
                value = np.zeros(len(those), np.int64)
                for b in block.tolist():
                    value = value << 1 | (fp[those] >> np.uint64(b) & np.uint64(1)).astype(np.int64)
                order = np.lexsort((value, of))
                named = (of << 22 | value)[order]  # a block has 11 bits at most
                work.append((named, those[order], np.setdiff1d(bits, block)))


def spanning_links(key: np.ndarray, fp: np.ndarray, free: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links between fingerprints of one key (rows sorted by key) that connect what is within the radius: each fingerprint with
    the smallest of its component in the bucket. `free` are the bits that rows of one key need not share. In a
    bucket rows are compared with the rows 1, 2, 3 ... behind them, so memory is linear."""
    root = np.arange(len(fp))

    def find(x: np.ndarray) -> np.ndarray:
        while True:
            up = root[x]
            if (up == x).all():
                return x
            root[x] = root[up]
            x = root[x]

    for bucket, number in buckets(key, fp, free):
        n, stored = len(number), planes(fp[number])
        rows, lag = np.arange(n), 0
        while True:
            lag += 1
            rows = rows[rows + lag < n]
            rows = rows[bucket[rows] == bucket[rows + lag]]
            if not len(rows):
                break
            apart = rows[find(number[rows]) != find(number[rows + lag])]
            close = near(stored, apart, lag, radius)
            for i, j in zip(number[close].tolist(), number[close + lag].tolist()):
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                while root[j] != j:
                    root[j] = root[root[j]]
                    j = root[j]
                if i != j:
                    root[max(i, j)] = min(i, j)
    top = find(np.arange(len(fp)))
    linked = np.flatnonzero(top != np.arange(len(fp)))
    return fp[top[linked]], fp[linked]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v: links that span the components of the distinct fingerprints `fp`; radius at most 2."""
    if radius > 2:
        raise ValueError("the bucket keys are complete for a radius of at most 2")
    block = lambda i: F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))
    keys = [F.struct(F.lit(16 * i + j).alias("pair"), (block(i) * 65536 + block(j)).alias("value")) for i in range(4) for j in range(i)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of the last key, which the next batch may go on with
        for b in and_end(batches):
            key, fp = (np.empty(0, np.int64), np.empty(0, np.int64)) if b is None else (b["key"].to_numpy(), b["fp"].to_numpy())
            if held is not None:
                key, fp = np.r_[held[0], key], np.r_[held[1], fp]
            if b is not None and len(key):
                cut = int((key != key[-1]).sum())  # sorted: the last key's rows are the last
                held = key[cut:], fp[cut:]
                key, fp = key[:cut], fp[:cut]
            pair = key >> 32
            for p in np.unique(pair).tolist():
                free = np.concatenate([np.arange(16 * t, 16 * t + 16) for t in range(4) if t not in (p >> 4, p & 15)])
                u, v = spanning_links(key[pair == p], fp[pair == p].view(np.uint64), free, radius)
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    def and_end(batches):
        yield from batches
        yield None

    return (
        distinct.select("fp", F.explode(F.array(*keys)).alias("k"))
        .select((F.col("k.pair") * F.lit(1 << 32) + F.col("k.value")).alias("key"), "fp")
        .repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "u long, v long")
    )


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that can be reached, for every node of `edges` (u, v); by large-star and small-star steps
    until nothing changes. Each step is a min by key and a join; a node with many links is never gathered."""

    def both(e):
        return e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def star(e, large: bool):
        """Link the larger (large) or smaller (small) neighbours of a node to its smallest neighbour or itself."""
        near = both(e) if large else e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        joined = near.join(least, F.col("u") == F.col("w"))
        if large:
            made = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            made = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        return made.filter("u <> v").distinct()

    def state(e):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = written(edges.filter("u <> v").distinct())
    before = state(edges)
    while before[0]:
        edges = written(star(star(edges, True), False))
        now = state(edges)
        if now == before:
            break
        before = now
    # at the end every node links to its root
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id: one row per row of `docs`; component_id is the smallest doc_id that can be reached by links.

    Null and empty texts have fingerprint 0 and link like any other. Rows of a null doc_id link as well, the smallest id leaves
    nulls out. Repeated rows stay, an empty table gives no row, other columns are not looked at. Equal fingerprints
    are one node, so copies of one text cost one comparison, however many there are.
    """
    rows = written(fingerprints(docs, shingle))
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = components(links(distinct, radius))
    named = distinct.join(groups, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = written(named)
    smallest = named.groupBy(F.col("root").alias("of")).agg(F.min("first").alias("component_id"))
    ids = named.join(smallest, F.col("root") == F.col("of")).select(F.col("fp").alias("known"), "component_id")
    return rows.join(ids, F.col("fp") == F.col("known")).select("doc_id", "fp", "component_id")
