"""Encoding and decoding text with trained vocabularies."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words whose tokens a task remembers, and letters of the longest of them.
KNOWN_WORDS, KNOWN_LETTERS = 200_000, 64
#: Vocabulary entries up to which matching is one regular expression on the JVM.
EXPRESSION_WORDS = 500


def merge_word(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The lowest-ranked adjacent pair merges first, the leftmost of equals; about n log n for n symbols."""
    n, symbols = len(symbols), list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i]
        if symbols[i] == "" or j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i], symbols[j], after[i] = symbols[i] + symbols[j], "", after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (new := ranks.get((symbols[k], symbols[after[k]]))) is not None:
                heapq.heappush(queue, (new, k))
    return [s for s in symbols if s]


def bpe_tokens(text: Column, merges: list[tuple[str, str]], split: str = r"\s+|\S+") -> Column:
    """Tokens of a text by merge ranks, within the matches of ``split`` (everything is in some match, so joining decodes)."""
    ranks = {tuple(m[:2]): k for k, m in enumerate(merges)}

    @F.arrow_udf("array<string>")
    def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find, known = re.compile(split).findall, {}

        def encode(t):
            out = []
            for w in find(t or ""):
                got = known.get(w)
                if got is None:
                    got = merge_word(list(w), ranks)
                    if len(w) <= KNOWN_LETTERS:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        known[w] = got
                out += got
            return out

        for texts in parts:
            yield pa.array(map(encode, texts.to_pylist()), pa.list_(pa.string()))

    return run(text)


def decoded(tokens: Column) -> Column:
    return F.array_join(tokens, "")


def longest_matches(text: Column, vocabulary: list[str]) -> Column:
    """Leftmost-longest literal matches of vocabulary entries; other text yields nothing.

    A small vocabulary is one alternation, longest first, on the JVM; a large one would be tried entry by entry there, and is looked up by
    length in Arrow batches instead, with the same matches.
    """
    words, none = sorted(set(vocabulary) - {""}, key=lambda w: (-len(w), w)), F.array().cast("array<string>")
    if not words:
        return none
    if len(words) <= EXPRESSION_WORDS:
        escaped = "|".join("".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in w) for w in words)
        return F.coalesce(F.regexp_extract_all(text, F.lit(escaped), 0), none)
    entries, lengths = set(words), sorted({len(w) for w in words}, reverse=True)

    @F.arrow_udf("array<string>")
    def run(texts: pa.Array) -> pa.Array:
        def encode(t):
            out, i, t = [], 0, t or ""
            while i < len(t):
                hit = next((t[i : i + n] for n in lengths if t[i : i + n] in entries), None)
                if hit:
                    out.append(hit)
                i += len(hit or " ")
            return out

        return pa.array(map(encode, texts.to_pylist()), pa.list_(pa.string()))

    return run(text)


_GPT2 = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pre_tokens(text: Column) -> Column:
    """The byte-level pre-tokenizer's pieces, every digit on its own."""
    return F.regexp_extract_all(text, F.lit("(?U)" + _GPT2), 0)


def byte_letters() -> dict[int, str]:
    """The printable letter for each byte."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}
