"""BPE and packing against tiktoken, tokenizers and a quadratic dynamic program."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lexiforge.llm import bpe, packing, tokens

RANKS = tokens.rank_file(P.path("byte_bpe_50k.tiktoken"))
TWIN = tiktoken.Encoding("twin", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = tokens.BytePairEncoder(RANKS, P.PATTERN)
FILE = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
PARTS = st.lists(st.sampled_from(["a", "b", " ", "  ", "\n", "\t", "'s", "'", "1", "é", "日本", "🙂", "\x1c", " ", "　", "!", "the", " x", "\r\n", "\x85", "<|endoftext|>", "aaaa"]), max_size=16).map("".join)


@settings(max_examples=600, deadline=None)
@given(st.one_of(PARTS, st.text(max_size=30)))
def test_ids_equal_the_libraries(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = OWN.encode(text).tolist()
    assert ids == TWIN.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()
    assert tokens.file_tokenizer(P.path("byte_bpe_50k.json")).encode(text).tolist() == FILE.encode(text, add_special_tokens=False).ids


def test_long_pre_tokens():
    text = "ab" * 30_000 + "a" * 40_001
    assert OWN.encode(text).tolist() == TWIN.encode_ordinary(text)


def test_other_vocabularies():
    multi = tokens.rank_file(P.path("byte_bpe_multi_50k.tiktoken"))
    own, twin = tokens.BytePairEncoder(multi, P.PATTERN), tiktoken.Encoding("m", pat_str=P.PATTERN, mergeable_ranks=multi, special_tokens={})
    for t in ("Ein übergroßer Satz, naïve café.", "日本語のテキスト", "мир"):
        assert own.encode(t).tolist() == twin.encode_ordinary(t)
    plain = tokens.FileTokenizer(P.path("word_bpe_49k.json"))  # no byte-level file: goes to the library
    assert plain.encode("Hello there").tolist() == Tokenizer.from_file(P.path("word_bpe_49k.json")).encode("Hello there", add_special_tokens=False).ids


def test_caches_stay_bounded():
    cache = tokens.Generations(lambda k: b"ab", limit=2040)  # ten entries
    assert {cache[f"{k % 37:02}"] for k in range(500)} == {b"ab"}
    assert len(cache) <= 10 and len(cache.old) <= 10
    cache = tokens.Generations(lambda k: k.encode() * 1000, limit=10_000)
    assert [len(cache[str(k)]) for k in range(50)] == [1000 * len(str(k)) for k in range(50)] and len(cache) < 10


def test_other_patterns_are_not_cut():
    pattern = r"[^,]+|,"
    own, twin = tokens.BytePairEncoder(RANKS, pattern), tiktoken.Encoding("p", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={})
    for t in ("one two, three  four,,five", "", " a b"):
        assert own.encode(t).tolist() == twin.encode_ordinary(t)
        assert own.decode(own.encode(t).tolist()) == t.encode()


def test_added_tokens_in_texts():
    own = tokens.file_tokenizer(P.path("byte_bpe_50k.json"))
    for t in ("a<|endoftext|>b", "<|endoftext|>", "x  <|endoftext|> y<|endoftext|><|endoftext|>", "<|endoftext", "a <|endoftext|>\n\n b"):
        assert own.encode(t).tolist() == FILE.encode(t, add_special_tokens=False).ids
    assert 50256 in own.encode("a<|endoftext|>b")


def test_round_trip_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in bpe.round_trip(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    for r in docs.collect():
        ids = TWIN.encode_ordinary(r.text)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_encoded_column(spark):
    (row,) = bpe.encoded(spark.createDataFrame([(1, "Hello, wörld")], "doc_id long, text string"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert row.ids == TWIN.encode_ordinary("Hello, wörld") and bytes(row.decoded) == "Hello, wörld".encode()


def slow_cost(places, penalty, window, each):
    best, at = [0.0], [0, *places]
    for k in range(1, len(at)):
        best.append(min(best[i] + padding(at[k] - at[i], window) + each + penalty[k - 1] for i in range(k) if at[k] - at[i] <= window))
    return best[-1]


def padding(length, window):
    return 0 if length & (length - 1) == 0 else window - length


def test_plan_is_optimal():
    rng = random.Random(2)
    for turn in range(300):
        places, at, each = [], 0, turn % 4
        for _ in range(rng.randrange(1, 25)):
            at += rng.randrange(1, 11)
            places.append(at)
        penalty = [rng.randrange(9) for _ in places]
        cuts = packing.plan_cuts(places, penalty, 20, each)
        assert cuts[-1] == places[-1] and all(b - a <= 20 for a, b in zip([0, *cuts], cuts))
        price = dict(zip(places, penalty))
        cost = sum(padding(b - a, 20) + each + price[b] for a, b in zip([0, *cuts], cuts))
        assert cost == slow_cost(places, penalty, 20, each)


def test_pieces_are_whole(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.packed(docs, P.path("byte_bpe_50k.json")).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    total = 0
    for r in docs.collect():
        ids = np.array([*FILE.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
        total += at
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 1024
    assert total / (1024 * len(by_sequence)) > 0.97


def test_segments_of_a_long_shard():
    shard, out = packing._Shard(3, 1024, None), []
    for k in range(700):
        out += shard.add(k, np.arange(1000, dtype="<u4"))
    out += shard.flush(True)
    assert sum(p[2] for p in out) == 700_000 and not shard.held
    assert {p[0] for p in out} == set(range(700))
