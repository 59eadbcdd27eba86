"""Frequency-pruned BPE: merges chosen by document frequency, tokens dropped once they stand almost only inside a merge."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.plans.merging import bounded_batches, merged_in_order, pieces
from lexiforge.storage import materialize

FIRST_MERGED = 0x110000
#: Cells of the tables in which a piece's pairs are marked; where they do not do, pairs are sorted.
MOST_CELLS = 1 << 25


@dataclass
class Picked:
    vocab: dict[str, int] = field(default_factory=dict)
    merges: list[tuple[str, str]] = field(default_factory=list)
    #: (step, event, left, right, token); events are merge, remove and readd.
    events: list[tuple[int, str, str, str, str]] = field(default_factory=list)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, offsets) of texts, of arrays of symbols or of arrays already packed; null is empty."""
    kind = column.type
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        column = column.fill_null([]) if column.null_count else column
        offsets = column.offsets.to_numpy().astype(np.int64)
        return column.values.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)[offsets[0] : offsets[-1]], offsets - offsets[0]
    is_text = pa.types.is_string(kind) or pa.types.is_large_string(kind)
    column = column.cast(pa.large_binary())
    column = column.fill_null(b"") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not is_text:
        return data.view(np.int32), offsets // 4
    begun = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # characters that begin before each byte
    return np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.int32), begun[offsets]


def _batches(batches):
    """(symbols, offsets) of bounded pieces of the only column."""
    for batch in batches:
        column = batch.column(0)
        # Four bytes a character at most, and at least one byte a character.
        sizes = pc.fill_null(pc.binary_length(column) if not pa.types.is_list(column.type) else pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        for i, j in pieces(np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))):
            yield _flat(column.slice(i, j - i))


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 4).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values, np.int32))])
    return pa.RecordBatch.from_arrays([column.cast(pa.binary())], names=["seq"])


def _distinct_pairs(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pair as one long, in how many of the sequences it stands)."""
    if len(values) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(int(values.max()) + 1, bool)
    seen[values] = True
    symbols = np.flatnonzero(seen)
    k, rows, size = len(symbols), len(offsets) - 1, np.diff(offsets)
    kind = np.int32 if k * k <= MOST_CELLS else np.int64
    place = np.zeros(len(seen), kind)
    place[symbols] = np.arange(k, dtype=kind)
    dense = place[values]
    pairs = dense[:-1] * kind(k) + dense[1:]
    edges = offsets[1:-1]
    pairs[edges[(edges > 0) & (edges < len(values))] - 1] = k * k  # never across two sequences
    if kind is np.int32:
        there = np.zeros(k * k + 1, bool)
        there[pairs] = True
        there[-1] = False
        each = np.flatnonzero(there)
        width = len(each) + 1
        if rows * width <= MOST_CELLS:  # a table with a cell for each sequence and pair
            at = np.full(k * k + 1, len(each), kind)
            at[each] = np.arange(len(each), dtype=kind)
            cells = at[pairs]
            cells += np.repeat(np.arange(rows, dtype=kind) * kind(width), size)[:-1]
            hit = np.zeros(rows * width, np.uint8)
            hit[cells] = 1
            return symbols[each // k] << 32 | symbols[each % k], hit.reshape(rows, width).sum(0, dtype=np.int64)[:-1]
    keys = np.sort((np.repeat(np.arange(rows, dtype=np.int64), size)[:-1] * (k * k + 1) + pairs)[pairs < k * k])
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    each, count = np.unique(keys[first] % (k * k + 1), return_counts=True)
    return symbols[each // k] << 32 | symbols[each % k], count


def _counted(packed: DataFrame, merges: list[tuple[int, int, int]], symbols: list[int]) -> DataFrame:
    """(key, n) in one pass: of each pair, as one long, in how many sequences it stands after the merges; of each of ``symbols``, as
    -1 - symbol, how often it occurs then."""

    def run(batches):
        total: dict[int, int] = {}
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["key", "n"])
        for values, offsets in _batches(batches):
            values, offsets = merged_in_order(values, offsets, merges)
            for s in symbols:
                total[-1 - s] = total.get(-1 - s, 0) + int(np.count_nonzero(values == s))
            for key, n in zip(*(x.tolist() for x in _distinct_pairs(values, offsets))):
                total[key] = total.get(key, 0) + n
            if len(total) > 1_000_000:
                yield out()
                total.clear()
        yield out()

    return packed.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _alphabet(packed: DataFrame) -> DataFrame:
    """(s, n): how often each symbol occurs."""

    def run(batches):
        total = np.zeros(FIRST_MERGED, np.int64)
        for values, _ in _batches(batches):
            found = np.bincount(values)
            total[: len(found)] += found
        s = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(s.astype(np.int32)), pa.array(total[s])], names=["s", "n"])

    return packed.mapInArrow(run, "s int, n long").groupBy("s").agg(F.sum("n").alias("n"))


def _rewritten(seqs: DataFrame, merges: list[tuple[int, int, int]]) -> DataFrame:
    """(seq) packed, with the merges applied; sequences without symbols are left out."""

    def run(batches):
        for values, offsets in _batches(batches):
            values, offsets = merged_in_order(values, offsets, merges)
            yield _packed(values, np.concatenate((offsets[:1], offsets[1:][np.diff(offsets) > 0])))

    return materialize(seqs.mapInArrow(run, "seq binary"), "picky")


def train(seqs: DataFrame, steps: int, threshold: float = 0.9, mode: str = "as_is", specials: tuple[str, ...] = (), min_df: int = 1, between: int = 4) -> Picked:
    """B05 over rows of one column, texts or array<int> of symbols.

    Each step takes the pair in most sequences (ties: smaller symbols), rewrites, and looks at both parts: a part whose inclusion in
    the merge reaches ``threshold`` is removed, and added again at the end if it still stands somewhere. "as_is" compares with the
    part's occurrences after the merge, "paper" with those before. Sequences are written again after every ``between`` merges; until then the
    merges are applied in order on the way.
    """
    if mode not in ("as_is", "paper"):
        raise ValueError(f"unknown mode {mode!r}")
    bounded_batches(seqs.sparkSession)
    now, done, names, pending = _rewritten(seqs, []), Picked(), {}, []
    text = lambda s: names.get(s) or chr(s)
    for r in _alphabet(now).orderBy("s").collect():  # an alphabet
        done.vocab[text(r["s"])] = r["n"]
    held_of: dict[int, int] = {ord(c): n for c, n in done.vocab.items()}  # occurrences of every symbol now
    asked: list[int] = []
    for step in range(steps + 1):
        # One pass tells what the last merge left of its parts and which pair is next.
        counted = _counted(now, pending, asked)
        first = F.min(F.when(F.col("key") >= 0, F.struct((-F.col("n")).alias("n"), "key"))).alias("best")
        found = counted.agg(first, *[F.coalesce(F.sum(F.when(F.col("key") == -1 - s, F.col("n"))), F.lit(0)).alias(f"n{s}") for s in asked]).first()
        if step:
            after = {s: found[f"n{s}"] for s in asked}
            before, merged = {s: held_of.get(s, 0) for s in (a, b)}, after[new]
            held_of.update(after)
            done.merges.append((text(a), text(b)))
            done.vocab[text(new)] = merged
            done.events.append((step - 1, "merge", text(a), text(b), text(new)))
            for part in dict.fromkeys((a, b)):
                held = (before if mode == "paper" else after).get(part, 0)
                inclusion = merged / held if held else 0.0
                if inclusion >= threshold and text(part) not in specials:
                    done.vocab.pop(text(part), None)
                    done.events.append((step - 1, "remove", text(a), text(b), text(part)))
                    if after.get(part, 0):
                        done.vocab[text(part)] = 1
                        done.events.append((step - 1, "readd", text(a), text(b), text(part)))
        best = found["best"]
        if step == steps or best is None or -best["n"] < min_df:
            break
        a, b, new = best["key"] >> 32, best["key"] & 0xFFFFFFFF, FIRST_MERGED + step
        names[new] = text(a) + text(b)
        asked = list(dict.fromkeys((a, b, new)))
        if len(pending) == between:
            now, pending = _rewritten(now, pending), []
        pending.append((a, b, new))
    return done


def inclusion(seqs: DataFrame, a: int, b: int) -> DataFrame:
    """A21 over rows of one column, texts or array<int> of symbols: (merged, left, right, ios_left, ios_right): how often a pair merges, how often its parts still stand alone then, and the ratios."""
    new = FIRST_MERGED

    def run(batches):
        n = np.zeros(3, np.int64)
        for values, offsets in _batches(batches):
            values, _ = merged_in_order(values, offsets, [(a, b, new)])
            n += [np.count_nonzero(values == s) for s in (new, a, b)]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in n.tolist()], names=["merged", "left", "right"])

    bounded_batches(seqs.sparkSession)
    sums = seqs.mapInArrow(run, "merged long, left long, right long")
    counted = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("merged", "left", "right")])
    share = lambda c: F.coalesce(F.col("merged") / F.nullif(F.col(c), F.lit(0)), F.lit(0.0)).alias(f"ios_{c}")
    return counted.select("merged", "left", "right", share("left"), share("right"))


def event_table(spark, done: Picked) -> DataFrame:
    return spark.createDataFrame(done.events, "step int, event string, left string, right string, token string")
