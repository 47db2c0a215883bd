"""Exact, substring and near duplicates against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from byteloom.llm import exact, simhash, substrings, suffixarray


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("hot", [1, 1000])
def test_exact(docs, texts, monkeypatch, keep, hot):
    monkeypatch.setattr(exact, "COLD_ROWS", hot)
    groups = {}
    for i, t in texts:
        groups.setdefault(t or "", []).append(i)
    best = min if keep == "smallest" else max
    want, kept = Counter(), Counter()
    for t, ids in groups.items():
        keeper = best((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        want.update((i, keeper, len(ids), sha) for i in ids)
        kept[(keeper, sha)] += 1
    got = rows_of(exact.exact_dedup(docs, keep))
    assert Counter((a, b, c, e) for a, b, c, _, e in got) == want
    assert Counter((a, e) for a, _, _, k, e in got if k) == kept


def test_empty_tables(no_docs):
    assert exact.exact_dedup(no_docs).count() == 0
    assert substrings.remove_repeats(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0


def test_suffix_order():
    rng = np.random.default_rng(0)
    for trial in range(30):
        data = bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(80, 1500)).astype(np.uint8))
        if trial % 3 == 0:
            data = data[: len(data) // 3] * 3
        starts = np.arange(len(data))
        order = np.concatenate([s for s, _ in suffixarray.buckets(suffixarray.Text(data), starts)])
        padded = data + bytes(300)
        heads = [padded[p : p + 70] for p in order.tolist()]
        assert sorted(order.tolist()) == starts.tolist() and heads == sorted(heads)


def removed(all_bytes, length):
    seen = Counter(b[j : j + length] for b in all_bytes for j in range(len(b) - length + 1))
    for b in all_bytes:
        spans = []
        for j in range(len(b) - length + 1):
            if seen[b[j : j + length]] > 1:
                if spans and j <= spans[-1][1]:
                    spans[-1][1] = j + length
                else:
                    spans.append([j, j + length])
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        yield len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("segments", [1, 256])
def test_substrings(docs, texts, monkeypatch, segments):
    """By window digests (every anchor counts as frequent) and by suffix-array blocks."""
    monkeypatch.setattr(substrings, "BUCKET_SEGMENTS", segments)
    want = Counter((i, *r) for (i, _), r in zip(texts, removed([(t or "").encode() for _, t in texts], 400)))
    assert Counter(rows_of(substrings.remove_repeats(docs).drop("kept"))) == want


def fingerprint(text):
    w = text.encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def by_components(nodes, near):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if near(a, b):
                root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def least_of(root):
    least = {}
    for n, r in root.items():
        least[r] = min(n, least.get(r, n))
    return {n: least[r] for n, r in root.items()}


def test_simhash(docs, texts):
    prints = [(i, fingerprint(t or "")) for i, t in texts]
    root = by_components(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    want = Counter((i, f"{p:016x}", least.get(root[p])) for i, p in prints)
    assert Counter(rows_of(simhash.near_duplicates(docs))) == want


@pytest.mark.parametrize("small", [1, 4, 16])
def test_links_of_dense_buckets(spark, monkeypatch, small):
    """Balls of fingerprints around few centres: large buckets link by stars, and lose no link."""
    monkeypatch.setattr(simhash, "SMALL_BUCKET", small)
    rng = random.Random(small)
    prints = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(60):
            p = centre
            for _ in range(rng.randint(0, 4)):
                p ^= 1 << rng.randrange(64)
            prints.add(p - (1 << 64) if p >> 63 else p)
    nodes = sorted(prints)
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    want = by_components(nodes, near)
    frame = spark.createDataFrame([(p,) for p in nodes], "fingerprint bigint")
    got = dict(rows_of(simhash.components(simhash.close_links(frame))))
    same = lambda roots: {frozenset(n for n in nodes if roots[n] == r) for r in set(roots.values())}
    assert same({n: got.get(n, n) for n in nodes}) == same(want)


def test_near_duplicate_stage(docs, texts):
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert max(ids.values()) == 1
    # The 20 edited copies leave one; copies and the changed long text leave one.
    assert [i for i in range(140, 160) if ids[i]] == [140]
    assert [i for i in (100, 101, 102) if ids[i]] == [100]
    assert [i for i in (200, 201, 202) if ids[i]] == [200] and [i for i in (203, 204) if ids[i]] == [203]
    assert ids[-5] and not ids[9] and ids[8] and ids[7] == 1
    clean = [i for i in range(60) if i not in (9,)]
    assert all(ids[i] for i in clean if len((texts[i][1] or "").split()) > 5)
    # A passage that texts share does not make them duplicates.
    assert sum(ids[i] for i in range(110, 122)) >= 10


def stage_set(text):
    w = text.lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def shares(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def kept_by_brute_force(texts):
    sets = [stage_set(t) for t in texts]
    root = by_components(range(len(texts)), lambda a, b: shares(sets[a], sets[b]))
    least = {}
    for i in range(len(texts)):
        least.setdefault(root[i], i)
    return sorted(least.values())


def stage(spark, texts):
    from byteloom.llm import common

    common.share_package(spark)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    return sorted(r.doc_id for r in simhash.drop_near_duplicates(rows).collect())


def test_stage_links_copies_that_tie_only_through_the_original(spark):
    """1,000 edited copies, near to the original but hardly to each other, are one group whatever the bucket's size."""
    rng = random.Random(11)
    original = [f"w{i}" for i in range(220)]
    copies = []
    for i in range(1000):
        copy = list(original)
        for j in range(4):
            copy[10 + 50 * j + rng.randrange(30)] = f"e{i}x{j}"
        copies.append(" ".join(copy))
    sets = [stage_set(t) for t in copies[:40]]
    assert all(shares(s, stage_set(" ".join(original))) for s in sets)
    assert sum(shares(a, b) for k, a in enumerate(sets) for b in sets[:k]) < 40
    assert stage(spark, copies + [" ".join(original)]) == [0]
    without = copies[:400]
    assert stage(spark, without) == kept_by_brute_force(without)


def changed(rng, words, kind, share):
    """The words with scattered edits, cut off, or with others appended, at about the share given."""
    n = len(words)
    if kind == "cut":
        return words[: int(n * share)]
    if kind == "appended":
        return words + [f"a{rng.random()}" for _ in range(int(n / share) - n)]
    out = list(words)
    for at in rng.sample(range(n), max(1, int(n * (1 - share) / (1 + share) / 5))):
        out[at] = f"e{rng.random()}"
    return out


@pytest.mark.parametrize("kind", ["cut", "appended", "edited"])
def test_stage_by_type_of_change(spark, kind):
    """Copies on both sides of 0.8 are dropped exactly where brute force drops them."""
    rng = random.Random(kind)
    texts = []
    for share in (0.72, 0.76, 0.79, 0.8, 0.81, 0.82, 0.85, 0.9):
        for _ in range(12):
            words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(40, 500))]
            texts += [" ".join(words), " ".join(changed(rng, words, kind, share))]
    want = kept_by_brute_force(texts)
    near = len(texts) - len(want)
    assert 24 <= near <= 90
    assert stage(spark, texts) == want


def test_prefixes_of_near_sets_meet():
    """Any two sets that share 0.8 have a token in common, at the bound too; an order by any counts will do."""
    rng = np.random.default_rng(8)
    for _ in range(2000):
        n = int(rng.integers(1, 60))
        drop, add = int(rng.integers(0, n // 5 + 1)), int(rng.integers(0, n // 4 + 1))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[drop:], rng.integers(0, 2**63, add).astype(np.uint64)]))
        if shares(set(a.tolist()), set(b.tolist())):
            count = rng.integers(0, 3, simhash.COUNTERS)
            assert set(simhash.prefix(a, count).tolist()) & set(simhash.prefix(b, count).tolist())


def test_sketches_of_near_sets_are_close():
    """Sets that share 0.8 stay well inside the Hamming bound, whichever side is longer; others are far beyond it."""
    rng = np.random.default_rng(12)
    for _ in range(300):
        n = int(rng.integers(simhash.SMALL_SET, 600))
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        add = rng.integers(0, 2**63, n // 4).astype(np.uint64)
        cut, grown = np.unique(base[: -(-4 * n // 5)]), np.unique(np.concatenate([base, add]))
        swapped = np.unique(np.concatenate([base[n // 9 :], add[: n // 9]]))
        whole = np.unique(base)
        other = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        bits = lambda a, b: int(np.bitwise_count((simhash.sketch(a) ^ simhash.sketch(b)).view(np.uint64)).sum())
        assert max(bits(whole, near) for near in (cut, grown, swapped)) <= simhash.SKETCH_BITS - 8
        assert bits(whole, other) > simhash.SKETCH_BITS


def test_blocks_and_hamming_check_link_close_fingerprints(spark):
    """Fingerprints below SKETCH_BLOCKS differing bits meet in a block whichever bits differ; far ones are not linked."""
    rng = random.Random(17)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows, want = [], set()
    for i in range(60):
        words = [rng.getrandbits(64) for _ in range(simhash.SKETCH_WORDS)]
        other = list(words)
        for bit in rng.sample(range(256), simhash.SKETCH_BLOCKS - 1):
            other[bit // 64] ^= 1 << bit % 64
        rows += [(2 * i, 100, [signed(w) for w in words]), (2 * i + 1, 100, [signed(w) for w in other])]
        want.add((2 * i, 2 * i + 1))
    nodes = spark.createDataFrame(rows, "node bigint, size bigint, sketch array<bigint>")
    links = simhash.close_forest(simhash.block_cells(nodes)).collect()
    assert {(min(r.u, r.v), max(r.u, r.v)) for r in links} == want


def test_sets_of_large_buckets_are_fetched_once(spark, monkeypatch):
    """Texts that pass the Hamming check in many large buckets but are not near: each set enters one cell, not one for each token."""
    rng = np.random.default_rng(21)
    base = rng.integers(0, 2**63, 500).astype(np.uint64)
    sets = {}
    for i in range(simhash.SMALL_BUCKET + 14):
        sets[i] = np.unique(np.concatenate([base[:420], rng.integers(0, 2**63, 80).astype(np.uint64)]))
    assert not any(5 * len(np.intersect1d(sets[0], s)) >= 4 * len(np.union1d(sets[0], s)) for i, s in sets.items() if i)
    count = np.full(simhash.COUNTERS, 2)
    count[(base[:60] % np.uint64(simhash.COUNTERS)).astype(np.int64)] = 1
    # Each of the shared tokens has a bucket of its own members, so that the buckets are not the same.
    rows = []
    for i, s in sets.items():
        tokens = [t for k, t in enumerate(base[:60].view(np.int64).tolist()) if (k + i) % 30]
        rows.append((i, len(s), tokens, simhash.sketch(s).tolist()))
    nodes = spark.createDataFrame(rows, "node bigint, size bigint, tokens array<bigint>, sketch array<bigint>")
    grams = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in sets.items()], "node bigint, grams array<bigint>")
    met, compare = [], simhash.cell_links

    def counted(cells, grams):
        met.append(cells.count())
        return compare(cells, grams)

    monkeypatch.setattr(simhash, "cell_links", counted)
    found = simhash.similar_links(nodes, lambda some: grams.join(some, "node"))
    assert found.count() == 0 and met[-1] and max(met) <= 2 * len(sets)


def test_components_are_found_in_few_jobs(spark):
    """Each join and exchange of a round leaves threads and plans on the driver, so a round has few of them."""
    rng = random.Random(17)
    ids = list({rng.randrange(-(2**62), 2**62) for _ in range(700)})
    pairs = list(zip(ids[:300], ids[1:300]))  # a path in random order
    pairs += [(ids[300], x) for x in ids[301:400]] + [(rng.choice(ids[400:]), rng.choice(ids[400:])) for _ in range(200)]
    pairs += pairs[:50] + [(a, a) for a in ids[:5]]
    known = {frozenset(p) for p in pairs}
    nodes = sorted({x for a, b in pairs for x in (a, b) if a != b})
    want = least_of(by_components(nodes, lambda a, b: frozenset((a, b)) in known))
    links = spark.createDataFrame(pairs, "u bigint, v bigint").repartition(7)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("components", "")
    got = rows_of(simhash.components(links))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(got) == sorted((n, r) for n, r in want.items() if n != r)
    assert len(tracker.getJobIdsForGroup("components")) <= 60


def test_contracted_links_are_stars():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 300):
        u, v = rng.integers(-50, 50, n), rng.integers(-50, 50, n)
        known = {frozenset(p) for p in zip(u.tolist(), v.tolist())}
        want = least_of(by_components(sorted({*u.tolist(), *v.tolist()}), lambda a, b: frozenset((a, b)) in known))
        a, b = simhash.contracted(u, v)
        assert sorted(zip(a.tolist(), b.tolist())) == sorted((x, r) for x, r in want.items() if x != r)


@pytest.mark.parametrize("words", [1, 1 << 17])
def test_many_texts_are_picked_without_a_broadcast_of_their_keys(spark, docs, texts, monkeypatch, words):
    """Beyond BROADCAST_NODES one bit a key is broadcast, in MAP_WORDS words at most; what is fetched is the same."""
    want = sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect() if r.doc_id is not None)
    monkeypatch.setattr(simhash, "BROADCAST_NODES", 0)
    monkeypatch.setattr(simhash, "MAP_WORDS", words)
    kept = simhash.drop_near_duplicates(docs)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == want
    keyed = docs.select("doc_id", *simhash.body_keys(simhash.common.text_of("text")))
    some = keyed.where("doc_id in (0, 3, 7, 205)").dropDuplicates(["doc_id"])
    found = simhash.picked(keyed, some.select("body_a"))
    ids = [r.doc_id for r in found.collect()]
    assert {0, 3, 7, 205} <= set(ids) and ids.count(7) == 3
    assert words == 1 or len(set(ids)) <= 12


def test_forgotten_tables_are_gone(spark):
    from pathlib import Path

    from byteloom.llm import common

    kept = common.stored(spark.range(5).toDF("n"), "kept")
    gone = common.stored(spark.range(5).toDF("n"), "gone")
    folder = Path(gone.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists()
    common.forget(gone)
    assert not folder.exists() and kept.count() == 5
