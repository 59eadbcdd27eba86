"""Substring dedup: word windows that repeat across documents, found by level-wise doubling.

Windows of a quarter of the length come first, then of half of it, then whole ones, and each level looks only at what repeats at the one
before. Below the full length only anchors are kept: of the half-windows inside a full window the one of the smallest hash, and inside
that the quarter of the smallest hash, so equal full windows have equal anchors at equal places on every level. What stands in one
document alone is dropped; the windows around the rest are extended to twice the length. Before the last level a hash of everything that the
windows of an anchor can cover settles long copies with one row for each anchor instead of one for each window. No level comes behind
the last, since words are removed where windows of the full length repeat, however far the copy goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.llm.tokens import Generations
from lexiforge.storage import materialize

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A hash of each run of ``length`` word hashes, by doubling: two halves make a whole."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = _mix(words + np.uint64(salt * 0x632BE59BD9B4E019 % (1 << 64)))
    span, done, have = 1, None, 0
    bits = length
    while bits:
        if bits & 1:
            done = power if done is None else _mix(done[: len(power) - have] * _A + power[have:])
            have += span
        bits >>= 1
        if bits:
            power = _mix(power[: len(power) - span] * _A + power[span:])
            span *= 2
    return done[:n]


def _minima(h: np.ndarray, reach: int) -> np.ndarray:
    """For each window of ``reach`` values, the place of its smallest; of equals the last."""
    n = len(h) - reach + 1
    best, at = h.copy(), np.arange(len(h))
    span = 1

    def fold(best, at, step):
        m = len(best) - step
        right = best[step:] <= best[:m]
        return np.where(right, best[step:], best[:m]), np.where(right, at[step:], at[:m])

    while span * 2 <= reach:
        best, at = fold(best, at, span)
        span *= 2
    if span < reach:
        best, at = fold(best, at, reach - span)
    return at[:n]


class _Words:
    """Word hashes of texts; remembers words, boundedly."""

    def __init__(self):
        self.of = Generations(xxhash.xxh64_intdigest, 32 << 20)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.of.__getitem__, words), np.uint64, len(words))


def _anchors(words: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) of each anchor of a document, with the hashes of the half-windows."""
    half = max(1, window // 2)
    h = window_hashes(words, half)
    at = _minima(h, window - half + 1)
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.append(cut[1:], len(at)) - 1
    return at[cut], cut, last, h


def _quarters(words: np.ndarray, window: int, places: np.ndarray) -> np.ndarray:
    """For the half-windows at ``places``, the hash of the quarter inside that is minimal by hash (half a half, rounded up)."""
    half = max(1, window // 2)
    q = window_hashes(words, (half + 1) // 2, 3)
    return q[_minima(q, half - (half + 1) // 2 + 1)[places]]


def _cover(words: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """A hash of the words of windows first..last together, from sums of salted powers."""
    odd = 0xD6E8FEB86659FD93
    w = _mix(words + np.uint64(1))
    powers = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(w), np.uint64(odd)))))
    inverse = np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(len(w), np.uint64(pow(odd, -1, 1 << 64))))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(w * powers[:-1])))
    end = last + window
    return _mix(((sums[end] - sums[first]) * inverse[first]) ^ _mix((end - first).astype(np.uint64)))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))



def anchor_table(docs: DataFrame, window: int) -> DataFrame:
    """(id, th, place, q, h, c): each anchor with the hashes of its quarter, of its half-window and of all its windows together."""
    names = ["id", "th", "place", "q", "h", "c"]

    def run(batches: Iterator[pa.RecordBatch]):
        hashes = _Words()
        for batch in batches:
            out = [[], [], [], [], [], []]
            for doc_id, th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pc.cast(batch.column(2), pa.binary())):
                words = (text.as_py() or b"").split()
                if len(words) < window or doc_id is None:
                    continue
                w = hashes(words)
                at, first, last, h = _anchors(w, window)
                for column, x in zip(out, (np.full(len(at), doc_id), np.full(len(at), th), at, _quarters(w, window, at), h[at], _cover(w, first, last, window))):
                    column.append(x)
            if out[0]:
                ids, th, at, q, h, c = (np.concatenate(x) for x in out)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(th), pa.array(at.astype(np.int32)), _signed(q), _signed(h), _signed(c)], names=names)

    return docs.select("id", "th", "t").mapInArrow(run, "id long, th long, place int, q long, h long, c long")


def _window_table(docs: DataFrame, window: int) -> DataFrame:
    """(id, th, first, k1, k2) of each window of the anchors listed in ``open``."""

    def run(batches: Iterator[pa.RecordBatch]):
        hashes = _Words()
        for batch in batches:
            for doc_id, th, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pc.cast(batch.column(2), pa.binary()), batch.column(3).to_pylist()):
                w = hashes((text.as_py() or b"").split())
                at, first, last, _ = _anchors(w, window)
                chosen = np.isin(at, wanted)
                size = last[chosen] - first[chosen] + 1
                places = np.repeat(first[chosen] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), doc_id)), pa.array(np.full(len(places), th)), pa.array(places.astype(np.int32)), _signed(window_hashes(w, window, 1)[places]), _signed(window_hashes(w, window, 2)[places])],
                    names=["id", "th", "first", "k1", "k2"],
                )

    return docs.mapInArrow(run, "id long, th long, first int, k1 long, k2 long")


def _kept_table(docs: DataFrame, window: int) -> DataFrame:
    """The result from texts with the anchors and windows to remove."""

    def run(batches: Iterator[pa.RecordBatch]):
        hashes = _Words()
        for batch in batches:
            rows = []
            for doc_id, text, anchors, windows in zip(batch.column(0).to_pylist(), pc.cast(batch.column(1), pa.binary()), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = (text.as_py() or b"").split()
                kept = words
                if anchors or windows:
                    edge = np.zeros(len(words) + 1, np.int64)
                    if anchors:
                        at, first, last, _ = _anchors(hashes(words), window)
                        chosen = np.isin(at, anchors)
                        np.add.at(edge, first[chosen], 1)
                        np.add.at(edge, last[chosen] + window, -1)
                    if windows:
                        places = np.array(windows)
                        np.add.at(edge, places, 1)
                        np.add.at(edge, places + window, -1)
                    stays = np.cumsum(edge)[:-1] == 0
                    kept = [x for x, s in zip(words, stays.tolist()) if s]
                data = b" ".join(kept)
                rows.append((len(words), len(words) - len(kept), hashlib.sha256(data).hexdigest(), data.decode("utf-8", "replace")))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string())))], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return docs.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept) for every row.

    Removed is each word covered by a window of ``window`` words whose sequence also starts in a row with a smaller id; the kept words
    are joined by one space. Windows are judged on the input. Rows that repeat an id count as one document, and never against
    each other. Rows with a null id remove nothing and cause nothing. Null and empty texts have no words. An empty table gives an
    empty result; other columns are not read.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("th"), F.col(text_col).cast("string").alias("t"))  # th tells apart rows that repeat an id
    anchors = materialize(anchor_table(texts, window), "anchors")
    # A level keeps what stands in more than one document. first_<level> is the smallest of them. Each aggregate is written out,
    # so that the join behind it meets two plain exchanges and its hot keys can be split.
    alive = anchors
    for level in ("q", "h"):
        repeated = alive.groupBy(level).agg(F.min("id").alias(f"first_{level}"), F.max("id").alias("last")).where(F.col(f"first_{level}") < F.col("last")).drop("last")
        alive = alive.drop("first_q").join(materialize(repeated, f"level_{level}"), level)
        alive = materialize(alive.drop("q", "first_q") if level == "h" else alive, f"alive_{level}")
    by_cover = materialize(alive.groupBy("h", "c").agg(F.min("id").alias("first_c"), F.min("first_h").alias("first_h")), "covers")
    # An anchor is settled where its whole cover is in a smaller document. If every cover of a half-window starts in its smallest
    # document, no window of it is left to judge.
    unsettled = materialize(by_cover.where("first_c > first_h").select("h").distinct(), "unsettled")
    judged = alive.drop("first_h").join(by_cover.drop("first_h"), ["h", "c"])
    settled = judged.where("first_c < id").select("id", "th", "place")
    # The last level: full windows of the anchors that are left, one document for each different cover.
    open_places = judged.where("first_c = id").join(unsettled, "h", "left_semi").groupBy("id", "th").agg(F.collect_set("place").alias("open"))
    windows = materialize(_window_table(texts.join(open_places, ["id", "th"]).select("id", "th", "t", "open"), window), "windows")
    by_window = materialize(windows.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("k1", "k2", F.col("first").alias("least")), "repeats")
    repeated = windows.join(by_window, ["k1", "k2"]).where("least < id").groupBy("id", "th").agg(F.collect_set("first").alias("windows"))
    covered = settled.groupBy("id", "th").agg(F.collect_set("place").alias("anchors"))
    marks = covered.join(repeated, ["id", "th"], "full").select("id", "th", "anchors", "windows")
    return _kept_table(texts.join(marks, ["id", "th"], "left").select("id", "t", "anchors", "windows"), window)


def word_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row."""
    return without_repeats(docs, id_col, text_col, window).select("doc_id", "n_words", "n_removed", "kept_sha256")
