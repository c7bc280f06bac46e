"""Operators on documents against brute force, on a fixture with every awkward kind of row."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerbrook.llm import chunks, decontaminate, fingerprint, mixing, sharding, simhash, suffix, superkmer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; a table may have columns of that name.
CLASHES = ("size", "chunk", "key", "hash", "copies", "first", "fp", "component_id", "bucket", "shard", "slot", "salt", "block", "wanted", "of", "stretch")


def words(rng, n):
    return " ".join(rng.choice(("alpha", "beta", "gamma", "delta", "eps", "zeta", "Eta", "theta", "iota", "kappa")) + rng.choice(("", "s", "ing", ".")) for _ in range(n))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(7)
    passage, other = words(rng, 60), words(rng, 45)
    texts = [None, "", "one", "\t \n", "ÄÖ ß 中文 text", words(rng, 6000), words(rng, 200)]
    texts += [words(rng, 40) + "\n" + passage + " " + words(rng, 30) for _ in range(4)]
    texts += [passage, other + other, words(rng, 20) + "  " + other, "ab " * 300, "x" * 700, "x" * 120, words(rng, 34), words(rng, 35)]
    near = words(rng, 300)
    texts += [near, near + " tail", near.upper(), near, near]
    rows = [(i * 3, t, "en", (None, "a", "b", "é", "z")[i % 5], 0) for i, t in enumerate(texts)]
    rows += [rows[8], (None, passage + " unnamed", None, "a", None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in CLASHES:
        df = df.selectExpr("*", f"'mine' as `{c}`")
    return rows, df


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def order(i):
    return 1 << 63 if i is None else i


def test_suffix_dedup_equals_brute_force(table):
    rows, df = table
    seen = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            w = b[k : k + 50]
            seen[w] = min(seen.get(w, order(None)), order(i))
    expected = []
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if seen[b[k : k + 50]] < order(i):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone) if not g)
        expected.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    got = suffix.dedup(df)
    for out in (got, suffix.dedup(df, heavy=3)):
        assert by_id(out, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(expected, key=str)
    assert all(sum(s["end"] - s["start"] for s in r.removed) == r.n_removed for r in got.collect())


@pytest.mark.parametrize("length,rounds", [(50, 2), (50, 1), (64, 3), (17, 1)])
def test_doubling_ranks_are_equality(length, rounds):
    text = ("abcab" * 30 + "xyz" + "abcab" * 30 + "qrs" * 40).encode()
    starts = np.arange(len(text) - length + 1)
    live, rank = suffix.double(text, starts, length, rounds)
    windows = [text[i : i + length] for i in starts]
    count = collections.Counter(windows)
    assert set(live.tolist()) == {i for i in starts if count[windows[i]] > 1}
    assert len(set(zip(rank.tolist(), (windows[i] for i in live)))) == len(set(rank.tolist())) == len({windows[i] for i in live})


def test_super_k_mer_dedup_equals_brute_force(table):
    rows, df = table
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    count = collections.Counter(tuple(w[k : k + 35]) for w in texts for k in range(len(w) - 34))
    expected = []
    for (i, *_), w in zip(rows, texts):
        gone = [0] * len(w)
        for k in range(len(w) - 34):
            if count[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [1] * 35
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        expected.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    for out in (superkmer.dedup(df), superkmer.dedup(df, heavy=3)):
        assert by_id(out, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(expected, key=str)


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(table):
    rows, df = table
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(len(rows)):
                if (fps[a] ^ fps[b]).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    expected = [(r[0], fp - (1 << 64) if fp >> 63 else fp, least[g]) for r, fp, g in zip(rows, fps, group)]
    assert by_id(simhash.near_duplicates(df), "doc_id", "fp", "component_id") == sorted(expected, key=str)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    flips = rng.integers(0, 7, 5000)
    b = a.copy()
    for k in range(6):
        b ^= np.where(k < flips, np.uint64(1) << rng.integers(0, 64, 5000, dtype=np.uint64), np.uint64(0))
    assert (simhash.within(a, b, radius) == (np.bitwise_count(a ^ b) <= radius)).all()


@pytest.mark.parametrize("crowded", [4, 512])
def test_crowded_buckets_give_every_link(monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = np.random.default_rng(3)
    free = np.r_[0:16, 32:48]
    fp = np.unique(rng.integers(0, 1 << 9, 700, dtype=np.uint64) << np.uint64(3) | rng.integers(0, 1 << 6, 700, dtype=np.uint64) << np.uint64(40))
    u, v = simhash.spanning_links(np.zeros(len(fp), np.int64), fp, free)

    def groups(pairs):
        root = {x: x for x in fp.tolist()}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[top(a)] = top(b)
        found = {}
        for x in root:
            found.setdefault(top(x), set()).add(x)
        return sorted(map(sorted, found.values()))

    close = np.argwhere(np.bitwise_count(fp[:, None] ^ fp) <= 2)
    assert groups(zip(u.tolist(), v.tolist())) == groups((int(fp[i]), int(fp[j])) for i, j in close)


@pytest.mark.parametrize("find, words", [(superkmer.runs_of(piece=1000), True), (superkmer.runs_of(), True), (suffix.runs_of(), False)])
def test_every_window_is_in_one_run(monkeypatch, find, words):
    monkeypatch.setattr(suffix, "PIECE", 1000)
    rng = random.Random(4)
    texts = [b"a " * 9000, b"b" * 9000, b" ".join(b"%d" % rng.randrange(40) for _ in range(3000)), b"c" * 3000 + b" x" * 3000 + b"\t", b"", b"one"]
    runs, _ = find(texts)
    chunk = b"".join(texts)
    n_windows = sum(max(0, len(t.split()) - 34) if words else max(0, len(t) - 49) for t in texts)
    every = np.concatenate([np.arange(a, a + n) for a, n in zip(runs.first.tolist(), runs.count.tolist())])
    assert len(every) == len(set(every.tolist())) == n_windows and runs.count.max() <= chunks.LONGEST
    names = {}
    for begin, end, count, name in zip(runs.begin.tolist(), runs.end.tolist(), runs.count.tolist(), runs.name.tolist()):
        text = chunk[begin:end]
        units = text.split() if words else text
        width = 35 if words else 50
        assert len(units) == count + width - 1
        for i in range(0, count, 97):
            assert names.setdefault(b" ".join(units[i : i + width]) if words else units[i : i + width], name) == name


def test_repetitive_texts(spark):
    line = "- " * 20000
    docs = [(1, line), (2, "x" + line[:5000]), (3, "z" * 30000), (4, "y" * 9 + "z" * 9000), (5, "ab " * 8000), (6, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed) for heavy in (chunks.HEAVY, 2) for r in superkmer.dedup(df, heavy=heavy).collect()}
    assert got == {1: (20000, 20000), 2: (2500, 2499), 3: (1, 0), 4: (1, 0), 5: (8000, 8000), 6: (0, 0)}
    for heavy in (chunks.HEAVY, 2):
        got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix.dedup(df, heavy=heavy).collect()}
        assert got == {1: (0, 0), 2: (5000, 1), 3: (0, 0), 4: (9000, 1), 5: (0, 0), 6: (0, 0)}


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (901, 900), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {v for k, v in got.items() if 0 < k <= 200} == {0} and got[901] == 900 and 5 in got


def test_containment_equals_brute_force(spark, table):
    rows, df = table
    rng = random.Random(3)
    texts = [t for _, t, *_ in rows if t]
    long = re.findall(r"\S+", max(texts, key=len))
    items = [" ".join(long[10:60]), " ".join(long[10:50]) + " " + words(rng, 6), " ".join(long[:9]) + " " + words(rng, 20), "one", None, "", words(rng, 12)]
    bench = spark.createDataFrame([(i, t, "mine") for i, t in enumerate([*items, None])] + [(None, "one", "mine")], "item_id long, text string, hash string")

    def shingles(t):
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if x]
        return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 5 else {" ".join(w)} - {""}

    docs = collections.defaultdict(set)
    for i, t, *_ in rows:
        docs[i] |= shingles(t)
    expected = [(d, i, len(shingles(q)), len(shingles(q) & s)) for d, s in docs.items() if d is not None
                for i, q in enumerate(items) if shingles(q) and len(shingles(q) & s) >= 0.8 * len(shingles(q))]
    got = by_id(decontaminate.contained(df, bench), "doc_id", "item_id", "n_item", "n_common")
    assert got == sorted(expected, key=str) and len(got) >= 3
    plan = decontaminate.contained(df, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_fingerprints(spark, table):
    rows, df = table
    got = fingerprint.compare_with_edit(df).collect()
    line = sorted(rows, key=lambda r: (r[0] is not None, order(r[0]) if r[0] is not None else 0, r[1] or ""))
    expected = []
    for k, (i, t, *_) in enumerate(line):
        t, follow = t or "", line[(k + 1) % len(line)][1] or ""
        edited = t[: len(t) - len(t) // 4] + follow[: len(t) // 4]
        a, b, c = (fingerprint.chunks(x.encode()) for x in (t, edited, follow))
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint.render(a), fingerprint.render(b), fingerprint.likeness(a, b), fingerprint.likeness(a, c)))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert by_id(fingerprint.fingerprints(df), "doc_id", "fingerprint") == sorted(((r[0], r[3]) for r in expected), key=str)


def test_chunks_resist_shifts():
    rng = random.Random(1)
    text = words(rng, 2000).encode()
    a = fingerprint.chunks(text)
    for other in (b"shifted by a few words " + text, text[300:], text[:5000] + b" inserted " + text[5000:]):
        assert fingerprint.likeness(a, fingerprint.chunks(other)) > 0.95
    assert fingerprint.likeness(a, fingerprint.chunks(words(random.Random(2), 2000).encode())) < 0.05
    ends = fingerprint.cuts(text)
    assert ends[-1] == len(text) and all(b - a <= fingerprint.MOST for a, b in zip([0, *ends], ends))
    assert fingerprint.parse(fingerprint.render(a)) == a and fingerprint.cuts(b"") == [] and fingerprint.cuts(b"ab") == [2]


def brute_targets(sizes, cap=3):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(cap * sizes[s] for s in capped)
        target = {s: cap * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix_meets_targets(spark, table):
    rows, df = table
    sizes, largest = collections.Counter(), collections.Counter()
    for _, t, _, s, _ in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes[s] += n
        largest[s] = max(largest[s], n)
    mixed = mixing.mix(df)
    got = mixed.collect()
    target = brute_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source] and 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)
    assert by_id(mixed, "doc_id", "source", "size") == sorted(((r[0], r[3], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in rows), key=str)
    assert by_id(mixing.mix(df.repartition(3)), "doc_id", "copies") == by_id(mixed, "doc_id", "copies")
    assert not re.search("Python|Pandas|Arrow", mixed._jdf.queryExecution().executedPlan().toString())


def test_mix_of_many_documents_needs_a_tree(spark):
    df = spark.range(20000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 50 as int)) as text", "if(id % 3 = 0, 'small', 'large') as source")
    got = mixing.mix(df).collect()
    for name in ("small", "large"):
        mine = [r for r in got if r.source == name]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= 25
        share = mine[0].target / mine[0].source_size
        assert {r.copies for r in mine} <= {int(share), int(share) + 1}
        # rounding favours no size
        big, small = ([r.copies for r in mine if (r.size > 25) is side] for side in (True, False))
        assert abs(np.mean(big) - np.mean(small)) < 0.05


@pytest.mark.parametrize("n_shards", [1, 5])
def test_shards(spark, table, n_shards):
    import zlib

    rows, df = table
    got = sharding.shard(df, n_shards).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, *_ in rows), key=str)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n_shards))


def test_shards_are_even_and_keep_groups(spark):
    df = spark.range(30000).selectExpr(
        "id as doc_id", "case when id % 3 = 0 then repeat('hot text ', 20) when id % 100 = 1 then concat('group ', id % 1000) else repeat(concat(id, ' '), cast(1 + id % 40 as int)) end as text")
    got = sharding.shard(df, 8).collect()
    size, shards, text = collections.Counter(), collections.defaultdict(set), {r.doc_id: r.text for r in df.collect()}
    slots = collections.defaultdict(set)
    for r in got:
        size[r.shard] += r.size
        shards[text[r.doc_id]].add(r.shard)
        slots[r.shard].add(r.slot)
    assert max(size.values()) < 1.02 * min(size.values())
    hot = shards.pop("hot text " * 20)
    assert len(hot) > 1 and all(len(s) == 1 for s in shards.values())
    assert all(s == set(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("ids", ["null", "7", "id % 3"])
def test_equal_rows_without_own_ids_are_dealt_evenly(spark, monkeypatch, ids):
    monkeypatch.setattr(sharding, "STRETCH", 500)
    docs = spark.range(0, 20000, 1, 6).selectExpr(f"if(id < 10000, {ids}, id) doc_id", "if(id < 10000, 'the same text', concat(id, repeat(' word', cast(id % 30 as int)))) text", "id row")
    words = docs.selectExpr("crc32(cast(text as binary)) text_crc32", "size(split(text, ' ')) n").distinct()
    got = sharding.shard(docs, 8).join(words, "text_crc32").groupBy("shard").agg(
        F.sum("size"), F.sum("n"), F.count("*"), F.countDistinct("slot"), F.min("slot"), F.max("slot")).collect()
    assert len(got) == 8 and all(r[3] == r[4] == r[6] + 1 and r[5] == 0 for r in got) and sum(r[3] for r in got) == 20000
    for resource, most in ((1, 1.02), (2, 1.05), (3, 1.05)):
        assert max(r[resource] for r in got) <= most * min(r[resource] for r in got)


def test_packing_prefers_the_complement():
    items = np.array([[10, 1, 1], [1, 10, 1], [10, 1, 1], [1, 10, 1]], dtype=float)
    found = sharding.pack(items, 2)
    assert sorted((found == s).sum() for s in range(2)) == [2, 2] and found[0] != found[2] and found[1] != found[3]
    assert len(sharding.pack(np.zeros((0, 3)), 2)) == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert suffix.dedup(docs).count() == superkmer.dedup(docs).count() == simhash.near_duplicates(docs).count() == 0
    assert mixing.mix(docs).count() == sharding.shard(docs, 4).count() == fingerprint.compare_with_edit(docs).count() == 0
    assert decontaminate.contained(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0
