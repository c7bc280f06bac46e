"""Cross-tokenizer alignment, embedding whitening, sanitisation of personal data."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerbrook.llm import alignment, queries, sanitise, whitening

# ---- alignment --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokens():
    return alignment.tokenizers(*(open(p, "rb").read() for p in queries.TOKENIZERS))


def brute_alignment(tokens, text):
    """n_a, n_b, n_groups, n_links, n_overlaps, groups, pairs with times, token by token on the whole text."""
    nothing = (0, 0, 0, 0, 0, "", {})
    if not text:
        return nothing
    whole, (a,), (b,) = (" " + text).encode(), tokens.ids_a([" " + text]), tokens.ids_b([text])
    if b"".join(tokens.bytes_a[i] for i in a) != whole or b"".join(tokens.bytes_b[i] for i in b) != whole:
        return nothing
    end_a, end_b = np.cumsum([len(tokens.bytes_a[i]) for i in a]), np.cumsum([len(tokens.bytes_b[i]) for i in b])
    start_a, start_b = np.r_[0, end_a[:-1]], np.r_[0, end_b[:-1]]
    overlaps = sum(((start_b < e) & (end_b > s)).sum() for s, e in zip(start_a, end_a))
    groups, pairs, before = [], Counter(), -1
    for cut in sorted({*end_a.tolist()} & {*end_b.tolist()}):
        x = [i for i, e in zip(a, end_a) if before < e <= cut]
        y = [i for i, e in zip(b, end_b) if before < e <= cut]
        groups.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
        pairs.update(i * len(tokens.bytes_b) + j for i in x for j in y)
        before = cut
    return len(a), len(b), len(groups), sum(pairs.values()), int(overlaps), ";".join(groups), dict(pairs)


AWKWARD = [
    "", " ", "  ", "a", " a", "a ", "a  ", "a  b", "x \n y", "\n", "a\n  b c", "\t x", "▁x", "a▁b", "<s> </s>", "<|endoftext|> <0x41>", "é😀\0x",
    "日本 語", "'s it's", "a\x1f b", "x\x85 y", "a   b", "word " * 50, "z" * 700, "12 345  6", "᠎ a​ b", "x y",
]


def test_texts_align_as_by_brute_force(tokens):
    draw = random.Random(5)
    parts = [*AWKWARD[1:8], "the", " ", " of", "\n", "tion", "é", ".", "9", "ß", "\xad"]
    texts = [*AWKWARD, None, *("".join(draw.choice(parts) for _ in range(draw.randint(1, 12))) for _ in range(600))]
    known = alignment.Known(tokens)
    for _ in range(2):  # the second time all units are known
        for text, got in zip(texts, alignment.aligned(texts, known, wants_groups=True), strict=True):
            assert (*got[:6], dict(zip(got[6].tolist(), got[7].tolist()))) == brute_alignment(tokens, text), repr(text)


def test_quick_ids_are_those_of_the_named_file(tokens):
    draw = random.Random(6)
    entries = [w for x in tokens.bytes_a if (w := x.decode("utf-8", "ignore")) and not alignment._EXOTIC.search(w)]
    words = [" " + "".join(draw.choice(entries) for _ in range(draw.randint(1, 4))) for _ in range(5000)]
    words += [" " + "".join(chr(draw.randrange(33, alignment.LATIN)) for _ in range(8)) for _ in range(1000)]
    assert tokens.quick_ids_a(words) == tokens.ids_a(words) and not tokens.joins_words


def test_sparse_products(monkeypatch):
    draw = np.random.default_rng(2)
    dense = [(draw.random(shape) < 0.2) * draw.integers(1, 5, shape) for shape in ((30, 20), (20, 40))]
    a, b = (alignment.Csr.of(*np.nonzero(m), m[np.nonzero(m)], *m.shape) for m in dense)
    for most in (3, 1 << 20):
        monkeypatch.setattr(alignment, "EXPANDED", most)
        out = a.times(b)
        back = np.zeros((30, 40), int)
        back[np.repeat(np.arange(30), out.lengths), out.indices] = out.data
        assert (back == dense[0] @ dense[1]).all()
    assert (a.transposed().times(a.transposed().transposed()).lengths == ((dense[0].T @ dense[0]) != 0).sum(axis=1)).all()


@pytest.mark.parametrize("most", [0, 10**6])
def test_pair_counts_over_the_corpus(spark, tokens, monkeypatch, most):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", most)
    texts = [*AWKWARD, None, *["the cat of thunder"] * 9, "unbelievable " * 30, "antidisestablishment nonsense", "the cat  of thunder"]
    rows = [(None if i % 5 == 0 else i % 7, t, "mine") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, pairs string").withColumnRenamed("pairs", "row").repartition(3)
    each = [brute_alignment(tokens, t) for t in texts]
    docs = Counter(p for e in each for p in e[6])
    best = Counter()
    for p, n in docs.items():
        best[p // len(tokens.bytes_b)] = max(n, best[p // len(tokens.bytes_b)])
    want = []
    for (doc, *_), e in zip(rows, each):
        n_best = sum(k for p, k in e[6].items() if docs[p] == best[p // len(tokens.bytes_b)])
        digest = hashlib.sha256(e[5].encode()).hexdigest() if e[0] else ""
        want.append((doc, *e[:5], digest, n_best, sum(k * docs[p] for p, k in e[6].items())))
    got = alignment.align(df, *queries.TOKENIZERS).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "n_best", "count_sum")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert alignment.align(df.limit(0), *queries.TOKENIZERS).count() == 0


# ---- whitening ---------------------------------------------------------------------------------


def integers(vectors):
    return np.floor(np.array(vectors, dtype=float) * 1024).astype(np.int64) + 100_000


def test_components_are_those_of_the_covariance(spark):
    draw = np.random.default_rng(4)
    vectors = (draw.standard_normal((700, 24)) * np.linspace(0.05, 2, 24) + 3).astype(np.float32)
    vectors[400:] = vectors[399]  # a very common vector
    bad = [(None, None, 1), (7, [], 1), (8, [1.0] * 23, 1), (9, [None] + [0.0] * 23, 1), (9, [float("nan")] * 24, 1), (9, [float("-inf")] * 24, 1), (9, [1e300] * 24, 1)]
    rows = [(i % 600, [float(c) for c in v], i) for i, v in enumerate(vectors)] + bad
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, x int").repartition(5)
    got = whitening.whiten(df).collect()
    x = integers(vectors)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    assert len(got) == 8 * n and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    exact = Counter(int(v) for v in ((n * x - sums) ** 2).sum(axis=1))
    assert Counter(r.deviation for r in got if r.component == 3) == exact
    for k in range(1, 9):
        mine = sorted((r for r in got if r.component == k), key=lambda r: (r.vec_id, r.whitened))
        assert mine[0].explained == pytest.approx(values[-k] / values.sum(), rel=1e-12)
        want = centred @ axes[:, -k] / np.sqrt(values[-k])
        sign = np.sign(want[np.abs(want).argmax()] * max((r.whitened for r in mine), key=abs))
        assert np.allclose(sorted(r.whitened for r in mine), np.sort(sign * want), atol=1e-9)


def test_tables_without_enough_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0])] * 5, schema)).count() == 0
    plane = [(i, [float(i % 5), float(i // 5), float(i % 5 + i // 5), 1.0, 0.0]) for i in range(25)]
    got = whitening.whiten(spark.createDataFrame(plane, schema)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 50 and got[0].identity_error < 1e-9
    assert sum({r.component: r.explained for r in got}.values()) == pytest.approx(1)


@pytest.mark.parametrize("values", [[3, 3, 3, 2, 2, 0, 0], [5, 0, 0], [1] * 9, list(range(12, 0, -1))])
def test_bidiagonalisation_finds_equal_and_zero_values(values):
    draw = np.random.default_rng(1)
    d = len(values)
    turn = np.linalg.qr(draw.standard_normal((d, d)))[0]
    x = np.linalg.qr(draw.standard_normal((60, d)))[0] * np.array(values) @ turn.T
    halves = np.array_split(x, 3)
    right, band = whitening.bidiagonalise(
        lambda *state: whitening._step(halves, np.zeros(d), *state), d, np.linalg.norm(x), 4)
    assert np.allclose(right.T @ right, np.eye(right.shape[1]), atol=1e-12)
    found = np.linalg.svd(band, compute_uv=False)
    assert np.allclose(found, sorted(values, reverse=True), atol=1e-10)
    assert np.count_nonzero(band - np.diag(np.diag(band)) - np.diag(np.diag(band, 1), 1)) == 0


def test_early_end_keeps_the_leading_triplets(monkeypatch):
    monkeypatch.setattr(whitening, "ALL_STEPS", 8)
    draw = np.random.default_rng(3)
    x = draw.standard_normal((400, 60)) * (0.5 ** np.arange(60))
    calls = []
    right, band = whitening.bidiagonalise(lambda *s: calls.append(1) or whitening._step([x], np.zeros(60), *s), 60, np.linalg.norm(x), 4)
    assert len(calls) < 60 and np.allclose(np.linalg.svd(band, compute_uv=False)[:4], np.linalg.svd(x, compute_uv=False)[:4], rtol=1e-12)


def test_deviations_are_exact_or_null():
    small = np.array([[1, 2], [3, 5]])
    assert whitening.deviations(small, 2, [4, 7]) == [4 + 9, 4 + 9]
    # beyond 53 bits, and beyond 63
    assert whitening.deviations(np.array([[3, 5]]), 10**9, [10**9 - 1, 4 * 10**9]) == [(2 * 10**9 + 1) ** 2 + (10**9) ** 2]
    assert whitening.deviations(np.array([[3, 5], [1, 4]]), 10**9, [10**9, -10**10]) == [None, None]


# ---- personal data -------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def brute_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")) or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            found.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


CASES = [
    "", "a@b.c@d.e", "a@b.c_d@e.f", "@@a@b.", "a@b..c", "x@y.z.", "me@mail.example.com, you@x-y.org!", "1.2.3.4.5.6.7.8", "300.1.2.3.4.5.6", "0255.001.0.0",
    "1.2.3", "9" * 30 + ".1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 4", "4111  1111 1111 1111", "+1 (743) 555-3824", "++1 2345678901 -", "+1 23",
    "378282246310005", "+12345678901234567", "٣.1.2.3", "a@b.c" * 5, "5555 5555 5555 4444+1 555 555 5555", "1 2 3 4 5 6 7 8 9 0 1 2 3 4",
]


def test_base_spans_equal_the_patterns():
    draw = random.Random(8)
    texts = [*CASES, *("".join(draw.choice("01249 -.+@()aZ_é\n") for _ in range(draw.randint(1, 60))) for _ in range(15000))]
    texts += ["".join(draw.choice("0123456789") for _ in range(16)) + draw.choice(["", " ", "-1"]) for _ in range(2000)]
    for text in texts:
        got = ",".join(f"{sanitise.KINDS[k]}:{s}:{e}" for s, k, e, _ in sanitise.base_spans(text))
        assert got == brute_spans(text), repr(text)


@pytest.mark.parametrize("piece", ["a", "1", "1.", "1 ", "+1", "@", "a@b", "-", "+1(", "a@b.c", "1.1.1.1 "])
def test_long_monotonous_texts_take_linear_time(piece):
    sanitise.base_spans(piece * (1_000_000 // len(piece)))


def people(spark):
    draw = random.Random(3)
    filler = lambda n: " ".join(f"w{draw.randint(0, 400)}" for _ in range(n))
    texts = [f"{filler(20)} Marisol Quintero writes from kira@mail.example.com {filler(20)} quintero" for _ in range(6)]
    texts += [f"{filler(30)} the plumber kira@mail.example.com {filler(5)}" for _ in range(2)]
    texts += [f"{filler(10)} only once Xenolith near 10.1.2.3 {filler(4)}"] * 40  # copies are one observation
    texts += [f"{filler(40)} the" for _ in range(150)] + [f"{filler(9)} writes {filler(9)}" for _ in range(3)] + [None, "", "Quintero alone"]
    return texts, spark.createDataFrame([(None if i % 9 == 0 else i % 50, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string")


def test_terms_that_reveal_an_entity_go_in_its_texts_only(spark):
    texts, df = people(spark)
    got = sanitise.personal_data(df.repartition(4)).collect()
    assert len(got) == len(texts)
    clear = sanitise.sanitise(df).collect()
    for r in clear:
        if r.text is None or "@" not in r.text:
            assert r.sanitised == (r.text if r.text is None or "10.1" not in r.text else r.text.replace("10.1.2.3", "[IP]"))
        elif "Marisol" in r.text:
            assert "arisol" not in r.sanitised and "uintero" not in r.sanitised and "[EMAIL]" in r.sanitised
    assert clear[0].row == "x" and set(clear[0].asDict()) == {"doc_id", "text", "row", "sanitised"}


def test_disclosure_equals_brute_force(spark):
    texts, df = people(spark)
    n, entity, term, both, held = 0, Counter(), Counter(), Counter(), {}
    for text in texts:
        n += 1
        spans = sanitise.base_spans(text or "")
        masked = text or ""
        for s, _, e, _ in spans:
            masked = masked[:s] + " " * (e - s) + masked[e:]
        words = [(m.start(), m[0].lower()) for m in re.finditer(r"\w+", masked)]
        term.update({w for _, w in words})
        pairs = set()
        for s, k, _, v in spans:
            before, after = [w for p, w in words if p < s], [w for p, w in words if p > s]
            pairs |= {(f"{sanitise.KINDS[k]}:{v}", w) for w in before[-sanitise.WINDOW :] + after[: sanitise.WINDOW]}
        entity.update({f"{sanitise.KINDS[k]}:{v}" for _, k, _, v in spans})
        both.update(pairs)
        for p in pairs:
            held.setdefault(p, set()).add(text)
    want = {
        p: (len(held[p]), np.log(n * c / (entity[p[0]] * term[p[1]])) / np.log(n / entity[p[0]]))
        for p, c in both.items() if len(held[p]) >= sanitise.SUPPORT
    }
    got = {(r.entity, r.term): (r.n_texts, r.disclosure) for r in sanitise.disclosures(sanitise.scan(df.repartition(3))).collect()}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)
    assert got["email:kira@mail.example.com", "marisol"][1] > sanitise.GENERALISE > got["email:kira@mail.example.com", "the"][1]


def test_digest_columns(spark):
    rows = [(i, t, 1) for i, t in enumerate(CASES)] + [(None, None, 1), (3, CASES[3], 1)]
    got = sanitise.counts_and_digests(sanitise.personal_data(spark.createDataFrame(rows, "doc_id long, text string, base int"))).collect()
    want = [(i, *(brute_spans(t or "").count(k) for k in PATTERNS), hashlib.sha256(brute_spans(t or "").encode()).hexdigest()) for i, t, _ in rows]
    assert sorted((tuple(r)[:5] + (r.base_sha256,) for r in got), key=str) == sorted(want, key=str)
    assert sanitise.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_marks_of_sanitised_texts():
    text = "Call Bob 77 at +1 555 555 5555 now"
    assert sanitise.sanitised(text, [(5, 5, 8), (9, 5, 11), (15, 3, 30), (31, 4, 34)]) == "Call [NAME] [NUMBER] at [PHONE]"
    assert sanitise.sanitised(text, [(0, 4, 4), (15, 1, 20), (15, 3, 30)]) == " Bob 77 at [IP] now"
