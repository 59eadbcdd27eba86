"""Merge application on columns of symbol sequences, vectorised over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Symbols that are worked on together; a longer sequence is a piece of its own.
PIECE = 1 << 20
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end by their bytes and not only by their rows, unless the session says how."""
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def pieces(offsets: np.ndarray, most: int = PIECE):
    """(first, behind the last) of runs of whole sequences that have at most ``most`` symbols together; a longer one is alone."""
    first = 0
    while first < len(offsets) - 1:
        behind = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, behind
        first = behind


def rewritten(values: np.ndarray, offsets: np.ndarray, left: np.ndarray, right: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """B01 on flat sequences: from the left, each pair that is in the table becomes its new symbol and both are consumed.

    The table is sorted by (left, right). Matches that overlap form runs; of a run every other match counts, from its first.
    """
    n = len(values)
    if n < 2 or not len(left):
        return values, offsets
    keys = (values[:-1].astype(np.int64) << 32) | values[1:]
    table = (left.astype(np.int64) << 32) | right
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    hit = table[at] == keys
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    hit[inner - 1] = False  # never across two sequences
    k = np.arange(n - 1)
    begin = np.maximum.accumulate(np.where(hit & ~np.concatenate(([False], hit[:-1])), k, 0))
    hit &= (k - begin) % 2 == 0
    out = values.copy()
    places = np.flatnonzero(hit)
    out[places] = new[at[places]]
    keep = np.ones(n, bool)
    keep[places + 1] = False
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], kept_before[offsets]


def merged_in_order(values: np.ndarray, offsets: np.ndarray, merges: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """B01 for (left, right, new) merges one after the other, each over all sequences."""
    for a, b, new in merges:
        if len(hit := np.flatnonzero((values[:-1] == a) & (values[1:] == b))):
            hit = hit[~np.isin(hit + 1, offsets)]  # never across two sequences
            if a == b and len(hit):  # of a run every other one, from its first
                begin = np.maximum.accumulate(np.where(np.diff(hit, prepend=-2) > 1, np.arange(len(hit)), 0))
                hit = hit[(np.arange(len(hit)) - begin) % 2 == 0]
            values = values.copy()
            values[hit] = new
            keep = np.ones(len(values), bool)
            keep[hit + 1] = False
            values, offsets = values[keep], offsets - np.searchsorted(hit + 1, offsets)
    return values, offsets


def _in_pieces(df: DataFrame, column: str, work: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``df`` with ``column`` (array<int>) as ``work`` makes it of the (symbols, offsets) of bounded runs of rows."""
    names = df.columns
    place = names.index(column)

    def run(batches):
        for batch in batches:
            col = batch.column(place)
            col = col.fill_null([]) if col.null_count else col
            offsets = col.offsets.to_numpy().astype(np.int64)
            symbols = col.values.to_numpy(zero_copy_only=False)
            for i, j in pieces(offsets):
                values, at = work(symbols[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                new = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([new if k == place else batch.column(k).slice(i, j - i) for k in range(batch.num_columns)], names=names)

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)


def apply_merges(df: DataFrame, column: str, merges: Iterable[tuple[int, int, int]]) -> DataFrame:
    """``df`` with ``column`` (array<int>) rewritten by (left, right, new) merges; the table is a few thousand rows of a round."""
    table = np.array(sorted(merges), np.int64).reshape(-1, 3)
    return _in_pieces(df, column, lambda values, offsets: rewritten(values, offsets, table[:, 0], table[:, 1], table[:, 2].astype(np.int32)))


def apply_in_order(df: DataFrame, column: str, merges: list[tuple[int, int, int]]) -> DataFrame:
    """``apply_merges`` for each merge in turn, in one pass."""
    return _in_pieces(df, column, lambda values, offsets: merged_in_order(values, offsets, merges))
