"""Document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes. A chunk ends where its low bits are zero: more bits
before the usual length than after it (normalised chunking), so lengths gather around it; never
below `least`, always at `most`. Boundaries depend on the bytes nearby only, so a shifted passage
gives the same chunks. The fingerprint is the set of chunk digests with their lengths, and two
fingerprints are as alike as the bytes of common chunks make of the smaller one (containment).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import no_null, parts, text_bytes

LEAST, USUAL, MOST = 16, 48, 192
STRICT, LOOSE = (1 << 7) - 1, (1 << 4) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: gear values and digests come from this rule, not from a table."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GEAR = (_mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """hash[i] = sum of gear[data[i - k]] << k for k < 32, by doubling: every byte counts for 32 positions."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        if len(h) <= k:
            break
        wider = h.copy()
        wider[k:] += h[:-k] << np.uint32(k)
        h = wider
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of one text."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    # the top bits of a gear hash have seen most bytes
    h = gear(np.frombuffer(data, np.uint8)) >> np.uint32(16)
    hits = np.flatnonzero((h & np.uint32(LOOSE)) == 0)
    strict = (h[hits] & np.uint32(STRICT)) == 0
    out, start = [], 0
    for at, is_strict in zip((hits + 1).tolist(), strict.tolist()):
        while at - start > MOST:
            start += MOST
            out.append(start)
        if at - start >= USUAL or is_strict and at - start >= LEAST:
            out.append(at)
            start = at
    while n - start > MOST:
        start += MOST
        out.append(start)
    if start < n:
        out.append(n)
    return out


def chunks(data: bytes) -> dict[int, int]:
    """Digest -> length of the distinct chunks of one text."""
    ends = cuts(data)
    out, start = {}, 0
    for end in ends:
        out[int.from_bytes(hashlib.blake2b(data[start:end], digest_size=6).digest(), "big")] = end - start
        start = end
    return out


def render(found: dict[int, int]) -> str:
    """Digests in ascending order, 12 hex digits and 2 for the length each."""
    return "".join(f"{d:012x}{found[d]:02x}" for d in sorted(found))


def parse(fingerprint: str) -> dict[int, int]:
    return {int(fingerprint[i : i + 12], 16): int(fingerprint[i + 12 : i + 14], 16) for i in range(0, len(fingerprint), 14)}


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """Bytes of the common chunks over those of the smaller set; two empty sets are alike, an empty and another are not."""
    if not a or not b:
        return float(not a and not b)
    if len(b) < len(a):
        a, b = b, a
    common = sum(n for d, n in a.items() if d in b)
    return min(1.0, common / min(sum(a.values()), sum(b.values())))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row of `docs`: null texts are empty (empty fingerprint), repeated rows stay, a null
    doc_id is kept, an empty table gives no row, other columns are not looked at. No shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b["doc_id"], pa.array([render(chunks(t.encode())) for t in b["text"].to_pylist()], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_null("text").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def with_successor(docs: DataFrame, each: int = 2 << 20) -> DataFrame:
    """doc_id, text and `stretch`, `lent`: stretches of ascending ids, each followed by the first row of the next one (lent).

    So a task that has a stretch sees the next document of every row of it, and the text is shuffled once. The cut ids
    are one long per stretch. The last stretch is lent the first document of all.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), no_null("text").alias("text"))
    n = parts(text_bytes(docs), each)
    at = rows.agg(F.percentile_approx("key", F.array(*(F.lit(i / n) for i in range(n))), F.lit(min(100 * n, 1_000_000))).alias("ids"), F.min("key").alias("least")).first()
    ids = sorted({at["least"], *(at["ids"] or [])} - {None})
    if not ids:
        return rows.select("key", "doc_id", "text", F.lit(0).alias("stretch"), F.lit(False).alias("lent"))
    edges = np.array(ids, dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b["key"].to_numpy(zero_copy_only=False).astype(np.int64)
            own = np.searchsorted(edges, keys, side="right") - 1
            first = np.flatnonzero(edges[own] == keys)
            pick = pa.array(np.concatenate([np.arange(len(keys)), first]))
            stretch = np.concatenate([own, (own[first] - 1) % len(edges)]).astype(np.int32)
            lent = np.concatenate([np.zeros(len(keys), bool), np.ones(len(first), bool)])
            taken = pa.Table.from_batches([b]).take(pick)
            yield from taken.append_column("stretch", pa.array(stretch)).append_column("lent", pa.array(lent)).combine_chunks().to_batches()

    return (
        rows.mapInArrow(deal, "key long, doc_id long, text string, stretch int, lent boolean")
        .repartition(max(8, n // 8), "stretch")  # several stretches each, so that they even out
        .sortWithinPartitions("stretch", "lent", "key", "text")
    )


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows; each is done when the one after it is there."""
    before = None  # stretch, doc_id, text, chunks
    for b in batches:
        out: list[list] = [[] for _ in range(7)]
        for stretch, lent, doc_id, text in zip(b["stretch"].to_pylist(), b["lent"].to_pylist(), b["doc_id"].to_pylist(), b["text"].to_pylist()):
            if before is None and lent:
                continue  # one lent row is enough
            own = chunks(text.encode())
            if before is not None:
                _, prev_id, prev, found = before
                cut = len(prev) - len(prev) // 4
                edited = (prev[:cut] + text[: len(prev) // 4]).encode()
                changed = chunks(edited)
                for column, value in zip(out, (prev_id, len(prev), hashlib.sha256(edited).hexdigest(), render(found), render(changed), likeness(found, changed), likeness(found, own))):
                    column.append(value)
            before = None if lent else (stretch, doc_id, text, own)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))], [c.split()[0] for c in COMPARED.split(", ")])


def compare_with_edit(docs: DataFrame) -> DataFrame:
    """COMPARED per row: the fingerprints of the text and of its edited text (last quarter of the code points replaced by as
    many, or all, of the next document's first) and how alike the text's is to the edited text's and to the next document's.

    Next is by ascending doc_id, nulls first, equal ids by text, the first after the last; a single row is its own next.
    """
    return with_successor(docs).mapInArrow(_compared, COMPARED)
