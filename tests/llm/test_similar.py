"""Near-duplicate removal by exact Jaccard similarity of five-word shingle sets, against brute force."""

import random

from lexiforge.llm import simhash


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near(x, y):
    a, b = shingles(x), shingles(y)
    return 5 * len(a & b) >= 4 * len(a | b)


def groups(texts):
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if near(texts[i], texts[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def found(spark, texts, **settings):
    rows = simhash.similar_groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **settings).collect()
    assert len(rows) == len(texts)
    return [r.component_id for r in sorted(rows, key=lambda r: r.id)]


def words(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_a_repeated_line_does_not_link_different_texts(spark):
    rng = random.Random(1)
    line = words(rng, 16)
    texts = [" ".join(words(rng, 200) + line * 20) for _ in range(6)]
    assert found(spark, texts) == list(range(6))


def test_no_link_below_the_threshold(spark):
    """Pairs whose fingerprints are close enough and whose sets are not."""
    rng = random.Random(2)
    texts = []
    for _ in range(40):
        w = words(rng, 300)
        texts.append(" ".join(w))
        for k in rng.sample(range(1, 59), 8):
            w[k * 5] = "other"
        texts.append(" ".join(w))
    assert all(not near(a, b) for a, b in zip(texts[::2], texts[1::2]))
    assert found(spark, texts) == list(range(80)) == groups(texts)


def test_a_failed_proposal_hides_no_link(spark):
    """Clusters around texts that resemble each other too little: both, and only they, stay whole."""
    rng = random.Random(3)
    texts = []
    for _ in range(6):
        w = words(rng, 300)
        for _ in range(2):
            for _ in range(5):
                v = list(w)
                v[rng.randrange(300)] = "own" + str(rng.random())
                texts.append(" ".join(v))
            for k in rng.sample(range(1, 59), 9):
                w[k * 5] = "other"
    rng.shuffle(texts)
    want = groups(texts)
    assert len(set(want)) == 12 and found(spark, texts) == want == found(spark, texts, first_bands=1, cell_limit=8)


def changed(rng, at_least, below):
    """A text and a copy of a similarity in the range, made by replacing words that share no shingle."""
    while True:
        w = words(rng, 400)
        v = list(w)
        for k in rng.sample(range(1, 79), rng.randrange(4, 12)):
            v[k * 5] = "other"
        a, b = shingles(" ".join(w)), shingles(" ".join(v))
        if at_least <= len(a & b) / len(a | b) < below:
            return [" ".join(w), " ".join(v)]


def test_pairs_around_the_threshold(spark):
    rng = random.Random(4)
    texts = [t for _ in range(200) for t in changed(rng, 0.78, 0.85)]
    want = groups_of_pairs(texts)
    assert 0 < sum(a == b for a, b in zip(want[::2], want[1::2])) < 200 and found(spark, texts) == want


def groups_of_pairs(texts):
    """Texts 2 k and 2 k + 1 are a pair; different pairs share next to nothing."""
    return [k - k % 2 if near(texts[k - k % 2], texts[k - k % 2 + 1]) else k for k in range(len(texts))]


def test_equal_sets_with_repeats_and_short_texts(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(5):
        line, rest = words(rng, 12), words(rng, 100)
        texts += [" ".join(line * 2 + rest), " ".join(line * 20 + rest)]
    for k in range(60):
        w = words(rng, 8 + k % 4)
        texts += [" ".join(w), " ".join([*w, "more"])]
    want = groups_of_pairs(texts)
    assert want == [k - k % 2 for k in range(130)] and found(spark, texts) == want
