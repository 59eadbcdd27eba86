"""Near, exact and substring dedup against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from lexiforge.llm import components, exact_dedup, simhash, substring


def corpus(seed=1, n=120, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for k in range(n):
        if out and rng.random() < 0.5:
            w = list(rng.choice(out))
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        else:
            w = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 3) * words)]
        out.append(w)
    return [" ".join(w) for w in out]


def slow_fingerprint(text, k):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_simhash_equals_brute_force(spark):
    texts = corpus() + ["", "one", "ONE two", "Ünï ÄÖ tab\tnew\nline  x"]
    prints = [slow_fingerprint(t, 4) for t in texts]
    want = roots(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    rows = simhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {k: f"{p:016x}" for k, p in enumerate(prints)}
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(want))


@pytest.mark.parametrize("limit", [100_000, 8])
def test_trie_join_with_hot_cells_taken_apart(spark, limit):
    rng = random.Random(limit)
    keys = {rng.getrandbits(64) for _ in range(60)}
    base = rng.getrandbits(64)
    while len(keys) < 260:
        x = base
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        keys.add(x)
    keys = list(keys)
    want = roots(len(keys), [(i, j) for i in range(len(keys)) for j in range(i) if (keys[i] ^ keys[j]).bit_count() <= 4])
    df = spark.createDataFrame([(k.to_bytes(8, "big"), i) for i, k in enumerate(keys)], "fp binary, rep long")
    links = simhash.near_links(df, 4, simhash.contiguous_bands(1, 5), 1, cell_limit=limit, batch_rows=50)
    found = {r.u: r.root for r in components.component_roots(links, "a", "b").collect()}
    assert [found.get(i, i) for i in range(len(keys))] == want


def test_trie_forest_prunes_dense_clusters():
    rng = np.random.default_rng(3)
    keys = np.unique(np.uint64(0x123456789ABCDEF0) ^ rng.integers(0, 1 << 14, 9000, dtype=np.uint64)).reshape(-1, 1)
    label = simhash.trie_forest(keys, np.array([[0, len(keys), 0, len(keys)]]), 4)
    assert (label == 0).all()


def test_similar_documents_are_found(spark):
    """Five-word shingles at a similarity of 0.85 and more are caught, unrelated documents stay."""
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = []
    for k in range(40):
        w = [rng.choice(vocabulary) for _ in range(400)]
        texts.append(" ".join(w))
        v = list(w)
        for _ in range(6):
            v[rng.randrange(len(v))] = rng.choice(vocabulary)
        texts.append(" ".join(v))
    kept = [r.doc_id for r in simhash.keep_one_of_each_group(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()]
    assert sorted(kept) == list(range(0, 80, 2))


def test_components_of_a_hub_and_a_chain(spark):
    links = [(0, k) for k in range(1, 300)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5), (None, 3), (7, None)]
    found = {r.u: r.root for r in components.component_roots(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert all(found[k] == 0 for k in range(1, 300)) and all(found[k] == 1000 for k in range(1001, 1101)) and len(found) == 399


@pytest.mark.parametrize("fan_in,keep", [(2, "largest"), (16, "smallest")])
def test_exact_groups(spark, fan_in, keep):
    rng = random.Random(fan_in)
    rows = [(k, rng.choice(["A b", "a B", "É", "é", "", None, "x y", "hot", "HOT", "hot"])) for k in range(200)]
    rows += rows[:20]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(9), keep=keep, fan_in=fan_in).collect()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for k, t in rows:
        groups.setdefault((t or "").translate(lower), []).append(k)
    assert len(got) == len(rows)
    by_id = {k: (t or "").translate(lower) for k, t in rows}
    pick = max if keep == "largest" else min
    for r in got:
        ids = groups[by_id[r.doc_id]]
        assert (r.keep_id, r.group_size, r.text_sha256) == (pick(ids), len(ids), hashlib.sha256(by_id[r.doc_id].encode()).hexdigest())
    assert sorted(r.doc_id for r in got if r.kept) == sorted(map(pick, groups.values()))


def brute_force_kept(rows, window):
    first = {}
    for k, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, k), k)
    out = []
    for k, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("window,seed", [(50, 1), (50, 2), (7, 3), (2, 4)])
def test_substring_dedup(spark, window, seed):
    rng = random.Random(seed)
    passages = [[f"p{rng.randrange(40)}" for _ in range(rng.randrange(window, 3 * window))] for _ in range(6)]
    rows = []
    for k in range(60):
        w = []
        for _ in range(rng.randrange(5)):
            w += rng.choice(passages) if rng.random() < 0.5 else [f"q{rng.randrange(20)}" for _ in range(rng.randrange(2 * window))]
        rows.append((k, " ".join(w)))
    rows += [(60, rows[3][1]), (61, "same " * (4 * window)), (62, "same " * (3 * window)), (63, None), (5, rows[5][1]), (9, rows[40][1])]
    rng.shuffle(rows)
    got = substring.word_digests(spark.createDataFrame(rows, "doc_id long, text string"), window=window).collect()
    assert sorted(map(tuple, got)) == brute_force_kept(rows, window)
