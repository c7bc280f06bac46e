"""Toxicity by subword-bag embeddings under a linear softmax.

Words are bags of character n-grams; every n-gram hashes to an embedding, a stretch of a few words is the
average of its n-gram embeddings, and a linear softmax over it gives two classes. Embeddings and softmax are
trained jointly in numpy. A document is as toxic as its most toxic stretch, so a few words in
a long text count, and training picks the stretch by the same rule. Misspelt words share most n-grams with the
word, hence its vectors. The model is trained on a bounded sample of labelled rows; every text is scored whole.
"""

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import no_null

BUCKETS = 1 << 16
DIMENSIONS = 8
#: Words of a stretch.
STRETCH = 4
#: Lengths of n-grams; a boundary mark counts as a character.
GRAMS = (3, 4, 5, 6)
#: Most labelled rows of each class that are read for training (the bound of the sample).
TRAIN_ROWS = 2000
#: Characters that are scored at a time; a longer text is scored at once.
PIECE = 1 << 20

_APART = np.zeros(128, bool)
_APART[[ord(c) for c in string.punctuation + string.whitespace]] = True
_FACTOR, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts with one 0 between words (runs other than ASCII punctuation and white space), at both
    ends as well; and the number of the text that each belongs to."""
    low = [t.lower() for t in texts]
    code = np.frombuffer("".join(["\n", *(t + "\n" for t in low)]).encode("utf-32-le", "surrogatepass"), np.uint32)
    apart = _APART[np.minimum(code, 127)] & (code < 128)
    keep = ~apart
    keep[0] = True
    keep[1:] |= ~apart[:-1]
    owner = np.repeat(np.arange(len(low), dtype=np.int32), [len(t) + 1 for t in low])
    owner = np.r_[np.int32(0), owner][keep]
    return np.where(apart, np.uint32(0), code)[keep].astype(np.uint64), owner


def subwords(code: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Where words start, and pairs (word number, bucket) of all n-grams and of whole words."""
    apart = code == 0
    starts = np.flatnonzero(~apart & np.r_[True, apart[:-1]])
    if not len(starts):
        return starts, []
    first = np.zeros(len(code), bool)
    first[starts] = True
    number = np.cumsum(first, dtype=np.int32) - 1
    bucket = lambda h: ((h * _SPREAD) >> np.uint64(48)).astype(np.int32)
    pairs = []
    inside = np.cumsum(apart, dtype=np.int32)
    h = code
    for n in range(2, max(GRAMS) + 1):
        if len(code) < n:
            break
        h = h[:-1] * _FACTOR + code[n - 1 :]
        if n in GRAMS:
            at = np.flatnonzero(inside[n - 2 : len(code) - 1] == inside[: len(code) - n + 1]) if n > 2 else np.arange(len(h))
            pairs.append((number[at + 1], bucket(h[at] + np.uint64(n))))
    place = np.arange(len(code)) - starts[np.maximum(number, 0)]
    mixed = (code + np.uint64(1)) * (_SPREAD * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)))
    mixed = np.where(apart, np.uint64(0), mixed ^ (mixed >> np.uint64(29)))
    pairs.append((np.arange(len(starts), dtype=np.int32), bucket(np.add.reduceat(mixed, starts))))
    return starts, pairs


def stretches(own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word of each text, start and end of all stretches: one begins at every word that has enough words behind it, and one
    at the start of a shorter text. `own` is the text of each word, in order."""
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    lengths = np.diff(np.r_[first, len(own)])
    left = np.repeat(first + lengths, lengths) - np.arange(len(own))
    heads = np.flatnonzero((left >= STRETCH) | (np.repeat(first, lengths) == np.arange(len(own))))
    return first, heads, heads + np.minimum(left[heads], STRETCH)


@dataclass
class Model:
    """One number per bucket (embedding times the difference of the softmax rows), the bias, the rate of the sample."""

    weights: np.ndarray
    bias: float
    rate: float

    def score(self, texts: list[str]) -> np.ndarray:
        out, start, size = [np.empty(0)], 0, 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= PIECE or i == len(texts) - 1:
                out.append(self._score(texts[start : i + 1]))
                start, size = i + 1, 0
        return np.concatenate(out)

    def _score(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), min(self.rate, 0.49))
        code, owner = characters(texts)
        starts, pairs = subwords(code)
        if not len(starts):
            return out
        total, count = np.zeros(len(starts)), np.zeros(len(starts))
        for word, bucket in pairs:
            total += np.bincount(word, self.weights[bucket], len(starts))
            count += np.bincount(word, minlength=len(starts))
        own = owner[starts]
        first, heads, ends = stretches(own)
        total, count = np.r_[0, np.cumsum(total)], np.r_[0, np.cumsum(count)]
        value = (total[ends] - total[heads]) / (count[ends] - count[heads])
        top = np.maximum.reduceat(value, np.searchsorted(heads, first))
        out[own[first]] = 1 / (1 + np.exp(-np.clip(top + self.bias, -40, 40)))
        return out


def train(texts: list[str], labels: list[int], epochs: int = 12, seed: int = 0, rate: float = 0.2) -> Model:
    """Fit on whole texts. Each epoch a document gives its currently most toxic stretch, a clean one two more at random."""
    rng = np.random.default_rng(seed)
    y = np.array(labels)
    # equal words share one list of n-grams
    vocabulary: dict[str, int] = {}
    numbers = []
    for text in texts:
        code, _ = characters([text])
        found = code.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").strip("\0")
        numbers.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in found.split("\0")] if found else [], dtype=np.int32))
    if not vocabulary or y.min() == y.max():
        constant = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(BUCKETS, np.float32), float(np.log((constant + 1e-3) / (1 - constant + 1e-3))), constant)
    of_word = np.repeat(np.arange(len(texts), dtype=np.int32), [len(x) for x in numbers])
    seg_words = np.concatenate(numbers)
    flats, counts = [], []
    listed = list(vocabulary)
    del numbers, vocabulary
    for at in range(0, len(listed), 20_000):
        part = listed[at : at + 20_000]
        _, pairs = subwords(characters([" ".join(part)])[0])
        word = np.concatenate([w for w, _ in pairs])
        flats.append(np.concatenate([b for _, b in pairs])[np.argsort(word, kind="stable")])
        counts.append(np.bincount(word, minlength=len(part)))
    del listed
    flat, n_grams = np.concatenate(flats), np.concatenate(counts)
    del flats
    gram_start = np.r_[0, np.cumsum(n_grams)]
    _, seg_start, seg_end = stretches(of_word)
    own, seg_len = of_word[seg_start], seg_end - seg_start
    first_of = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    docs = own[first_of]
    per_doc = np.diff(np.r_[first_of, len(own)])
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    g_embedding, g_softmax, g_bias = np.full_like(embedding, 1e-6), np.full_like(softmax, 1e-6), np.full_like(bias, 1e-6)
    grams_to = np.r_[0, np.cumsum(n_grams[seg_words])]
    seg_grams = grams_to[seg_end] - grams_to[seg_start]
    # both classes weigh the same, however many rows of them there are, so that 0.5 means the same at every size
    weight = np.where(y == 1, len(y) / 2 / max(1, y.sum()), len(y) / 2 / max(1, (1 - y).sum()))
    # the softmax starts on a random direction, so that embeddings get a gradient from the first step
    softmax[:, 1] = rng.normal(0, 0.5, DIMENSIONS)
    softmax[:, 0] = -softmax[:, 1]

    def ranges(starts, lengths):
        """All indices of several ranges, one after the other."""
        ends = np.cumsum(lengths)
        return np.repeat(starts - np.r_[0, ends[:-1]], lengths) + np.arange(ends[-1])

    for epoch in range(epochs):
        if epoch:
            line = embedding @ (softmax[:, 1] - softmax[:, 0])
            per_word = np.add.reduceat(line[flat], gram_start[:-1])  # one float32 per n-gram of the vocabulary
            values_to = np.r_[0, np.cumsum(per_word[seg_words].astype(float))]
            value = (values_to[seg_end] - values_to[seg_start]) / seg_grams
            highest = np.flatnonzero(value == np.repeat(np.maximum.reduceat(value, first_of), per_doc))
            top = highest[np.unique(own[highest], return_index=True)[1]]
        else:
            top = first_of + (rng.random(len(first_of)) * per_doc).astype(int)
        clean = y[docs] == 0
        more = np.concatenate([first_of[clean] + (rng.random(clean.sum()) * per_doc[clean]).astype(int) for _ in range(2)])
        if epoch < 3:  # before the ranking means anything, look at several stretches of toxic documents
            more = np.concatenate([more, *(first_of[~clean] + (rng.random((~clean).sum()) * per_doc[~clean]).astype(int) for _ in range(6))])
        picked = rng.permutation(np.concatenate([top, more]))
        for at in range(0, len(picked), 512):
            s = picked[at : at + 512]
            w = seg_words[ranges(seg_start[s], seg_len[s])]
            f = flat[ranges(gram_start[w], n_grams[w])]
            starts = np.r_[0, np.cumsum(seg_grams[s])[:-1]]
            mean = np.add.reduceat(embedding[f], starts, axis=0) / seg_grams[s][:, None]
            z = mean @ softmax + bias
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(s)), y[own[s]]] -= 1
            p *= weight[own[s]][:, None] / len(s)
            d_softmax, d_bias = mean.T @ p, p.sum(axis=0)
            d_mean = (p @ softmax.T) / seg_grams[s][:, None]
            buckets, inverse = np.unique(f, return_inverse=True)
            spread = np.repeat(d_mean, seg_grams[s], axis=0)
            d_embedding = np.stack([np.bincount(inverse, spread[:, k], len(buckets)) for k in range(DIMENSIONS)], axis=1).astype(np.float32)
            g_embedding[buckets] += d_embedding**2
            embedding[buckets] -= rate * d_embedding / np.sqrt(g_embedding[buckets])
            g_softmax += d_softmax**2
            softmax -= rate * d_softmax / np.sqrt(g_softmax)
            g_bias += d_bias**2
            bias -= rate * d_bias / np.sqrt(g_bias)
    return Model((embedding @ (softmax[:, 1] - softmax[:, 0])).astype(np.float32), float(bias[1] - bias[0]), float(y.mean()))


def held_out() -> Column:
    """Rows that are never trained on: crc32 of doc_id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Train on at most `train_rows` toxic and as many clean labelled rows, those with the smallest hash of doc_id.

    Rows that are held out, and labels or ids that are null, are left out. Repeated labels of a document: the larger one.
    Without labels of both classes the model gives the rate of the class that there is (0 without any).
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null")
        .filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    order = (F.xxhash64("doc_id"), "doc_id")
    chosen = known.filter("toxic = 1").orderBy(*order).limit(train_rows).unionByName(known.filter("toxic = 0").orderBy(*order).limit(train_rows))
    ids = {r["doc_id"]: int(r["toxic"] > 0) for r in chosen.collect()}  # at most 2 * train_rows
    if not ids:
        return train([], [])
    wanted = docs.sparkSession.createDataFrame([(i,) for i in ids], "wanted long")
    texts = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_null("text").alias("text")).join(F.broadcast(wanted), F.col("doc_id") == F.col("wanted"), "left_semi")
    )
    rows = sorted({(r["doc_id"], r["text"]) for r in texts.toLocalIterator()})
    return train([t for _, t in rows], [ids[i] for i, _ in rows])


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """`docs` with a score from 0 to 1 in a column of that name (not a name that `docs` has). Null and empty texts get the rate of the
    training sample, below 0.5; repeated rows get equal scores; an empty table stays empty. No shuffle."""
    return docs.withColumn(column, _scorer(model.weights, model.bias, model.rate)(no_null("text")))


def _scorer(weights, bias, rate):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(weights, bias, rate)
        for texts in batches:
            yield pd.Series(own.score(list(texts)))

    return F.pandas_udf(run, "double")
