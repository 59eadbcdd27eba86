"""Byte-level BPE on vocabulary files of public tokenizers, and the caches that the token operators share."""

from __future__ import annotations

import base64
import functools
import heapq
import json
import re
import struct

import numpy as np
import regex
from public_tokenizers import PATTERN

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")
#: Bytes that a cache holds in each of its two generations, about.
CACHE_BYTES = 128 << 20


def pieces(text: str) -> list[str]:
    """Cut before each space that follows a non-space: no pre-token crosses such a cut, and none looks across it.

    (A pre-token holds a space at its start only, or is all white space.)
    """
    if _SPACE_AFTER_SPACE.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    out = [" " + x for x in rest]
    return [first, *out] if first else out


class Generations(dict):
    """Values by key, made on demand, in bounded memory.

    At ``limit`` bytes the young entries become the old ones, and old ones that are used again become young. What is used often stays, and
    about twice ``limit`` bytes are held.
    """

    def __init__(self, make, limit: int = CACHE_BYTES):
        super().__init__()
        self.make, self.limit, self.held = make, limit, 0
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        size = 200 + len(key) + (len(value) if isinstance(value, bytes) else 0)  # with what Python adds to each object
        if self.held + size > self.limit:
            self.old, self.held = dict(self), 0
            self.clear()
        self.held += size
        self[key] = value
        return value


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class BytePairEncoder:
    """Encodes by ranks, each match of ``pattern`` on its own, without special tokens; decodes by joining bytes.

    Within a pre-token the adjacent pair of the lowest rank merges first, the leftmost of equals. Candidates wait in a
    hierarchical-bitmap queue: a bucket of linked-list positions for each rank, a word of 256 bits that says which of 256
    neighbouring ranks have a bucket, and a word above that says which words are not zero. Find-first-set in two words gives
    the next rank. An entry whose left part was swallowed or whose pair has another rank by now is stale and skipped, so a
    pre-token of n bytes costs about n queue operations however long it is.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte = [ranks[bytes([k])] for k in range(256)]
        #: Rank of the token that two tokens make side by side, for each way to cut a token in two.
        self.pairs = {
            (ranks[token[:k]] << 20) | ranks[token[k:]]: rank
            for token, rank in ranks.items() for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks
        }
        self.decimal = [str(k) for k in range(len(self.bytes_of))]
        self.find = regex.compile(pattern).findall
        #: Only of the public pattern is it known where a text may be cut.
        self.words = pattern == PATTERN
        self.cut = pieces if self.words else lambda text: [text] if text else []
        self.low = [0] * ((len(self.bytes_of) >> 8) + 1)
        self.bit = [1 << k for k in range(max(256, len(self.low)))]
        self.first = [self.pairs.get(self.byte[a] << 20 | self.byte[b], -1) for a in range(256) for b in range(256)]
        self.of_match = Generations(self._match, CACHE_BYTES // 2)
        self.of_piece = Generations(self._piece)

    def merge(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n, rank_of, low, bit, first = len(data), self.pairs.get, self.low, self.bit, self.first
        part = [*map(self.byte.__getitem__, data)]
        after, before = [*range(1, n + 1)], [*range(-1, n - 1)]
        pair = [first[a << 8 | b] for a, b in zip(data, data[1:])]
        pair.append(-1)
        buckets: dict[int, int | list[int]] = {}  # one position, or a heap of them
        top = 0
        for i, rank in enumerate(pair):
            if rank >= 0:
                if rank not in buckets:
                    buckets[rank] = i
                    low[rank >> 8] |= bit[rank & 255]
                    top |= bit[rank >> 8]
                elif type(held := buckets[rank]) is int:
                    buckets[rank] = [held, i]
                else:
                    held.append(i)  # rising, so a heap
        while top:
            lowest = top & -top
            word = lowest.bit_length() - 1
            bits = low[word]
            rank = (word << 8) + (bits & -bits).bit_length() - 1
            i = buckets[rank]
            if type(i) is int:
                del buckets[rank]
                bits &= bits - 1
                low[word] = bits
                if not bits:
                    top ^= lowest
            else:
                held, i = i, heapq.heappop(i)
                if len(held) == 1:
                    buckets[rank] = held[0]
            if pair[i] != rank:
                continue
            j = after[i]
            part[i] = rank
            part[j] = pair[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                new = pair[i] = rank_of(rank << 20 | part[k], -1)
                if new >= 0:
                    if new not in buckets:
                        buckets[new] = i
                        low[new >> 8] |= bit[new & 255]
                        top |= bit[new >> 8]
                    elif type(held := buckets[new]) is int:
                        buckets[new] = [held, i] if held < i else [i, held]
                    else:
                        heapq.heappush(held, i)
            else:
                pair[i] = -1
            h = before[i]
            if h >= 0:
                new = rank_of(part[h] << 20 | rank, -1)
                if new != pair[h]:
                    pair[h] = new
                    if new >= 0:
                        if new not in buckets:
                            buckets[new] = h
                            low[new >> 8] |= bit[new & 255]
                            top |= bit[new >> 8]
                        elif type(held := buckets[new]) is int:
                            buckets[new] = [held, h] if held < h else [h, held]
                        else:
                            heapq.heappush(held, h)
        return [x for x in part if x >= 0]

    def _match(self, match: str) -> bytes:
        ids = self.merge(match.encode("utf-8"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        if self.words and piece.isascii() and piece.isalpha() or self.words and piece[:1] == " " and piece.isascii() and piece[1:].isalpha():
            return self._match(piece)  # one match, as the pattern takes a word with the space before it
        found = self.find(piece)
        return self._match(piece) if len(found) == 1 else b"".join(map(self.of_match.__getitem__, found))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.of_piece.__getitem__, self.cut(text))), "<u4")

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@functools.cache
def encoder(path: str, pattern: str) -> BytePairEncoder:
    """One for each worker process."""
    return BytePairEncoder(rank_file(path), pattern)


class FileTokenizer:
    """Ids of a ``tokenizers`` file with add_special_tokens=False; the strings of its added tokens in a text give those tokens' ids.

    Where the file is plain byte-level BPE whose ids are its merge order, the same merges run in ``tiktoken`` between the added tokens,
    which is several times as fast and gives the same ids; any other file goes to ``tokenizers``.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens", ())
        self.limit = max([len(spec["model"]["vocab"]), *(x["id"] + 1 for x in added)])
        self.bytes_of = self._byte_level(spec)
        if self.bytes_of:
            import tiktoken

            self.run = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={b: k for k, b in self.bytes_of.items()}, special_tokens={}).encode_ordinary
            self.added = {x["content"]: x["id"] for x in added}
            self.around = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if self.added else lambda text: [text]
        else:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(path)

    @staticmethod
    def _byte_level(spec: dict) -> dict[int, bytes] | None:
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges", "dropout"))
        if not plain or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            return None
        if any(x.get(k) for x in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip")):
            return None
        letters, special = byte_letters(), {x["content"] for x in spec.get("added_tokens", ())}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"].get("".join(m)) for m in merges]
        if made != list(range(256, 256 + len(merges))):
            return None
        return {k: bytes(letters[c] for c in t) for t, k in model["vocab"].items() if t not in special}

    def token_bytes(self) -> list[bytes] | None:
        return self.bytes_of and [self.bytes_of.get(k, b"") for k in range(self.limit)]

    def encode(self, text: str) -> np.ndarray:
        if not self.bytes_of:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        ids: list[int] = []
        for k, part in enumerate(self.around(text)):
            ids += [self.added[part]] if k & 1 else self.run(part)
        return np.array(ids, "<u4")


@functools.cache
def file_tokenizer(path: str) -> FileTokenizer:
    return FileTokenizer(path)
