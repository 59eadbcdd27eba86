"""Counting, selection, merge application and training against plain Python."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiforge.operators import counts, metrics
from lexiforge.plans import bpe, encode, merging, picky
from lexiforge.plans.merging import apply_merges, rewritten


def greedy(seq, table):
    out, i = [], 0
    while i < len(seq):
        if i + 1 < len(seq) and (seq[i], seq[i + 1]) in table:
            out.append(table[seq[i], seq[i + 1]])
            i += 2
        else:
            out.append(seq[i])
            i += 1
    return out


def test_rewriting_equals_the_greedy_scan(spark):
    rng = random.Random(1)
    seqs = [[rng.randrange(4) for _ in range(rng.randrange(9))] for _ in range(400)]
    table = {(1, 1): 9, (1, 2): 10, (0, 3): 11, (3, 3): 12}
    t = np.array(sorted((a, b, n) for (a, b), n in table.items()), np.int64)
    offsets = np.cumsum([0] + [len(s) for s in seqs])
    values, at = rewritten(np.array([x for s in seqs for x in s], np.int32), offsets, t[:, 0], t[:, 1], t[:, 2].astype(np.int32))
    assert [values[a:b].tolist() for a, b in zip(at, at[1:])] == [greedy(s, table) for s in seqs]
    rows = apply_merges(spark.createDataFrame(list(enumerate(seqs)), "k int, seq array<int>"), "seq", [(a, b, n) for (a, b), n in table.items()]).collect()
    assert {r.k: r.seq for r in rows} == {k: greedy(s, table) for k, s in enumerate(seqs)}
    assert greedy([1, 1, 1, 1, 2], table) == [9, 9, 2] and greedy([1, 1, 1, 2], table) == [9, 10]


def test_pairs(spark):
    df = spark.createDataFrame([("aaa", 2), ("ab", 3), ("a", 5)], "text string, count long")
    assert {(r.a, r.b): r.cnt for r in counts.weighted_pairs(df).collect()} == {(97, 97): 4, (97, 98): 3}
    docs = spark.createDataFrame([("aaa",), ("ab",), ("ab ab",)], "text string")
    assert {(chr(r.a) + chr(r.b)): r.df for r in counts.document_pairs(docs).collect()} == {"aa": 1, "ab": 2, "b ": 1, " a": 1}
    assert counts.text_counts(docs.where("false")).collect() == []


def test_conflict_free_selection():
    ranked = [(1, 2, 10), (2, 3, 9), (4, 5, 8), (6, 6, 8), (1, 7, 7)]
    assert [p[:2] for p in counts.conflict_free(ranked, 3)] == [(1, 2), (4, 5), (6, 6)]


def test_top_pairs_are_ordered(spark):
    pairs = spark.createDataFrame([(2, 1, 5), (1, 2, 5), (1, 1, 9), (3, 3, 1)], "a int, b int, cnt long")
    assert [tuple(r)[:2] for r in counts.top_pairs(pairs, 3, 2).collect()] == [(1, 1), (1, 2), (2, 1)]
    assert [tuple(r)[:2] for r in counts.top_pairs(pairs, 3, 2, pairs.where("a = 1")).collect()] == [(2, 1)]


def test_merge_depth(spark):
    """(1,2) -> 9 and (9,3) -> 10: only the iterative mode sees the second."""
    seqs = spark.createDataFrame([([1, 2, 3], 10)], "seq array<int>, count long")
    deep = bpe.train(seqs, vocab_size=50, batch_merges=1, mode="iterative", initial=3)
    assert [m[1:3] for m in deep.merges] == [(1, 2), (bpe.FIRST_MERGED, 3)]
    assert deep.stopped == "no candidates"
    flat = bpe.train(seqs, vocab_size=50, batch_merges=1, mode="single_pass", initial=3, max_rounds=4)
    assert flat.merges[0][1:3] == (1, 2)


def slow_rounds(seqs, batch, rounds):
    names, next_id, merges, past = {}, bpe.FIRST_MERGED, [], set()
    by_text, text = {}, lambda s: names.get(s) or chr(s)
    for _ in range(rounds):
        pairs = Counter()
        for s, c in seqs:
            for p in zip(s, s[1:]):
                pairs[p] += c
        ranked = sorted(((a, b, c) for (a, b), c in pairs.items() if c >= 2 and (a, b) not in past), key=lambda x: (-x[2], x[0], x[1]))[: 3 * batch]
        chosen = counts.conflict_free(ranked, batch)
        if not chosen:
            break
        table = {}
        for a, b, c in chosen:
            t = text(a) + text(b)
            if t not in by_text:
                by_text[t] = next_id
                names[next_id] = t
                next_id += 1
            table[a, b] = by_text[t]
            past.add((a, b))
            merges.append((text(a), text(b), c))
        seqs = [(greedy(s, table), c) for s, c in seqs]
    return merges


def test_rounds_equal_plain_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(3, 30))).strip() or "a" for _ in range(150)]
    grouped = Counter(t for t in texts)
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    done = bpe.train(bpe.sequences(docs), vocab_size=10_000, batch_merges=2, max_rounds=4)
    assert [(done.text(a), done.text(b), c) for _, a, b, _, c in done.merges] == slow_rounds([([ord(x) for x in t], c) for t, c in grouped.items()], 2, 4)


def test_stop_rules(spark):
    none = spark.createDataFrame([], "seq array<int>, count long")
    assert bpe.train(none, 10).stopped == "no sequences"
    one = spark.createDataFrame([([1, 2], 5)], "seq array<int>, count long")
    assert bpe.train(one, 2).stopped == "vocabulary is full"
    with pytest.raises(ValueError):
        bpe.train(one, 9, mode="other")


def test_words_equal_the_library():
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    rng = random.Random(5)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 8))) for _ in range(400)]
    twin = Tokenizer(models.BPE())
    twin.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    twin.train_from_iterator([" ".join(words)], trainers.BpeTrainer(vocab_size=60, min_frequency=2, show_progress=False))
    import json

    want = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in json.loads(twin.to_str())["model"]["merges"]]
    tokens, merges = bpe.WordTrainer([(tuple(w), c) for w, c in Counter(words).items()]).run(60, 2)
    assert [m[:2] for m in merges] == want and len(tokens) == 60


def test_encoding(spark):
    docs = spark.createDataFrame([(1, "xabcab zb"), (2, None), (3, "")], "k int, t string")
    got = {r.k: r.x for r in docs.select("k", encode.longest_matches(F.col("t"), ["a", "ab", "abc", "b"]).alias("x")).collect()}
    assert got == {1: ["abc", "ab", "b"], 2: [], 3: []}
    merges = [("a", "b"), ("ab", "c"), ("c", "a")]
    got = {r.k: r.x for r in docs.select("k", encode.bpe_tokens(F.col("t"), merges).alias("x")).collect()}
    assert got == {1: ["x", "abc", "ab", " ", "z", "b"], 2: [], 3: []}
    pieces = spark.createDataFrame([("It's 123, né?",)], "t string").select(encode.pre_tokens(F.col("t")).alias("x")).first().x
    assert pieces == ["It", "'s", " 1", "2", "3", ",", " né", "?"]
    assert len(set(encode.byte_letters().values())) == 256


def test_driver_limit(spark):
    words = spark.createDataFrame([("ab", 3), ("cd", 2)], "token string, count long")
    assert bpe.train_words(words, 100)[1] == [("a", "b", 3), ("c", "d", 2)]
    with pytest.raises(ValueError):
        bpe.train_words(words, 100, driver_limit=1)


def test_artifacts():
    files = bpe.artifacts(["a", "b", "ab", "a"], [("a", "b"), (" ", "a")], ["<pad>", "a"])
    import json

    assert json.loads(files["vocab.json"]) == {"<pad>": 0, "a": 1, "b": 2, "ab": 3}
    assert json.loads(files["merges.json"]) == [["a", "b"], [" ", "a"]] and "Ġ a" in files["merges.txt"]


def slow_picky(seqs, steps, threshold, mode):
    names, events, seqs = {}, [], [list(s) for s in seqs]
    text = lambda s: names.get(s) or chr(s)
    for step in range(steps):
        df = Counter(p for s in seqs for p in set(zip(s, s[1:])))
        if not df:
            break
        (a, b), _ = min(df.items(), key=lambda x: (-x[1], x[0]))
        before = Counter(x for s in seqs for x in s)
        new = picky.FIRST_MERGED + step
        names[new] = text(a) + text(b)
        seqs = [greedy(s, {(a, b): new}) for s in seqs]
        after = Counter(x for s in seqs for x in s)
        events.append((step, "merge", text(a), text(b), text(new)))
        for part in dict.fromkeys((a, b)):
            held = (before if mode == "paper" else after)[part]
            if held and after[new] / held >= threshold:
                events.append((step, "remove", text(a), text(b), text(part)))
                if after[part]:
                    events.append((step, "readd", text(a), text(b), text(part)))
    return events


@pytest.mark.parametrize("mode", ["as_is", "paper"])
def test_picky(spark, mode):
    rng = random.Random(2)
    seqs = [[ord(rng.choice("abc")) for _ in range(rng.randrange(2, 12))] for _ in range(40)]
    done = picky.train(spark.createDataFrame([(s,) for s in seqs], "seq array<int>"), 5, 0.8, mode)
    assert done.events == slow_picky(seqs, 5, 0.8, mode)


def test_anomalies(spark):
    rows = [("x", 0.2)] * 9 + [("x", 0.9)] + [("same", 0.5)] * 4
    got = metrics.with_anomalies(spark.createDataFrame(rows, "g string, tokens_per_char double"), "g").collect()
    assert sum(r.anomaly for r in got) == 1 and max(r.z for r in got if r.z is not None) == pytest.approx(3.0)


def test_picky_of_texts_in_passes(spark):
    """Texts and symbols give the same; one pass a step over packed sequences: counting makes no row for a symbol or a pair of a text."""
    rng = random.Random(12)
    texts = ["".join(rng.choice("aab é😀") for _ in range(rng.randrange(0, 30))) for _ in range(60)] + [None, "", "a" * 9]
    seqs = [[ord(c) for c in t or ""] for t in texts]
    for rows, kind in ((texts, "text string"), (seqs, "seq array<int>")):
        done = picky.train(spark.createDataFrame([(r,) for r in rows], kind), 9, 0.5, between=2)
        assert done.events == slow_picky(seqs, 9, 0.5, "as_is")
    packed = picky._rewritten(spark.createDataFrame([(t,) for t in texts], "text string"), [])
    assert packed.schema.simpleString() == "struct<seq:binary>"


@pytest.mark.parametrize("cells", [1 << 25, 3000, 0])
def test_distinct_pairs(cells, monkeypatch):
    monkeypatch.setattr(picky, "MOST_CELLS", cells)
    rng = random.Random(13)
    seqs = [[rng.choice([5, 7, 9, 0x110001, *range(20, 60)]) for _ in range(rng.choice([0, 1, 2, 30]))] for _ in range(50)]
    keys, n = picky._distinct_pairs(np.array([x for s in seqs for x in s], np.int32), np.concatenate(([0], np.cumsum([len(s) for s in seqs]))))
    assert dict(zip(((k >> 32, k & 0xFFFFFFFF) for k in keys.tolist()), n.tolist())) == Counter(p for s in seqs for p in set(zip(s, s[1:])))


@pytest.mark.parametrize("driver_limit", [2, 40, 1000])
def test_word_rounds_merge_many_a_round(spark, driver_limit, monkeypatch):
    rng = random.Random(14)
    words = Counter("".join(rng.choice("aaabbcdé") for _ in range(rng.randrange(1, 9))) for _ in range(300))
    rows = spark.createDataFrame(list(words.items()), "token string, count long")
    rounds, counted = [], bpe.symbol_pairs
    monkeypatch.setattr(bpe, "symbol_pairs", lambda *a: rounds.append(1) or counted(*a))
    want = bpe.train_words(rows, 17, specials=["<pad>"])
    assert len(want[1]) == 11 and bpe.train_words_rounds(rows, 17, specials=["<pad>"], driver_limit=driver_limit) == want
    assert len(rounds) <= {2: 11, 40: 8, 1000: 3}[driver_limit]


def test_word_rounds_with_ties_beyond_the_ranking(spark, monkeypatch):
    rows = spark.createDataFrame([("ab", 3), ("cd", 3), ("abcd", 3), ("ef", 3), ("efg", 1), ("aaaa", 2)], "token string, count long")
    want = bpe.train_words(rows, 40, 1)
    for ranked in (1, 2, 3):
        monkeypatch.setattr(bpe, "RANKED", ranked)
        assert bpe.train_words_rounds(rows, 40, 1) == want


@pytest.mark.parametrize("pair", ["th", "aa"])
def test_inclusion_of_texts(spark, pair):
    texts = ["that th", "aaaaa", "t", "", None, "hta", "h"]
    a, b = map(ord, pair)
    seqs = [greedy([ord(c) for c in t or ""], {(a, b): picky.FIRST_MERGED}) for t in texts]
    n = Counter(x for s in seqs for x in s)
    for rows, kind in ((texts, "text string"), ([[ord(c) for c in t or ""] for t in texts], "seq array<int>")):
        got = picky.inclusion(spark.createDataFrame([(r,) for r in rows], kind), a, b).first()
        assert tuple(got)[:3] == (n[picky.FIRST_MERGED], n[a], n[b])


def test_merges_come_in_bounded_pieces(spark, monkeypatch):
    assert list(merging.pieces(np.array([0, 3, 3, 6, 20, 21, 22]), 6)) == [(0, 3), (3, 4), (4, 6)]
    monkeypatch.setattr(merging, "BATCH_BYTES", 4000)
    spark.conf.unset(merging.BATCH_KEY)
    rows = spark.createDataFrame([(k, [1, 2] * 50) for k in range(400)], "k int, seq array<int>").coalesce(1)
    done = apply_merges(rows, "seq", [(1, 2, 3)])

    def sizes(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    try:
        assert max(r.n for r in rows.mapInArrow(sizes, "n long").collect()) < 40
        assert sorted((r.k, tuple(r.seq)) for r in done.collect()) == [(k, (3,) * 50) for k in range(400)]
    finally:
        spark.conf.unset(merging.BATCH_KEY)
