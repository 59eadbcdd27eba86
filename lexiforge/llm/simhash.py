"""SimHash fingerprints and their near-duplicate self-join on a binary trie.

Fingerprints are cut into bit bands. Two fingerprints within the error budget agree on a whole band (always, if
there are more disjoint bands than errors), so each (band, cell) is the root of a trie that is joined with itself:
node pairs go down together, differing bits add up, and a pair of nodes is dropped once they exceed the budget or
once both nodes already lie in one component. Cells over ``cell_limit`` rows are first taken apart by the same
traversal as DataFrame steps, four bits at a time, so that no task holds an unbounded cell.

``near_duplicates`` links by fingerprints alone. ``similar_groups`` takes fingerprints of the different shingles for proposals only and holds
each against the shingle sets: edges that span a group first, at most as many as its rows in every band, and pairs only where that leaves it torn.
"""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.llm.components import component_roots
from lexiforge.llm.substring import window_hashes
from lexiforge.storage import materialize

SEED = 42
_BLOCK = 1 << 16
_PAIRS = 1 << 20
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15))


def _remixed(h: np.ndarray, k: int) -> np.ndarray:
    """Another 64 bits from each hash; k = 0 leaves the hash as it is."""
    if k == 0:
        return h
    z = h + np.uint64(int(_MIX[2]) * k % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * _MIX[0]
    z = (z ^ (z >> np.uint64(27))) * _MIX[1]
    return z ^ (z >> np.uint64(31))


def fingerprint(text: bytes | None, shingle_words: int = 4, n_words: int = 1) -> bytes:
    """SimHash of 64 x ``n_words`` bits, most significant byte first.

    A-Z are lower-cased; words are runs of non-space bytes; every shingle counts as often as it stands there. A text of
    fewer words is one shingle; a null text or one without words gives all zeros.
    """
    words = (text or b"").lower().split()
    if not words:
        return bytes(8 * n_words)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    k = min(shingle_words, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    ones = np.zeros(64 * n_words, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _BLOCK):
        pairs = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        h = np.array([digest(joined[s:e], SEED) for s, e in pairs], np.uint64)
        for w in range(n_words):
            bits = np.unpackbits(_remixed(h, w).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[64 * w : 64 * w + 64] += bits.sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).reshape(n_words, 64)[:, ::-1]
    return np.packbits(bits, axis=1).tobytes()


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int = 4, n_words: int = 1) -> DataFrame:
    """(id, fp binary) of every row; one pass over the text, no shuffle."""

    def run(batches):
        for batch in batches:
            texts = pc.cast(batch.column(1), pa.binary())
            out = [fingerprint(x.as_py(), shingle_words, n_words) for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, "id long, fp binary")


def contiguous_bands(n_words: int, count: int) -> list[list[int]]:
    """All bits in ``count`` disjoint bands: exact for budgets below ``count``."""
    cuts = [64 * n_words * k // count for k in range(count + 1)]
    return [list(range(a, b)) for a, b in zip(cuts, cuts[1:])]


def lossless_bands(n_words: int, budget: int, rows: int, cell_limit: int) -> list[list[int]]:
    """Bands that lose no pair within ``budget``, wide enough for ``rows`` fingerprints.

    Of ``budget + agree`` disjoint blocks at least ``agree`` hold no differing bit, so every choice of ``agree`` blocks is a band. More
    blocks make wider bands, hence smaller cells, for more copies of each row; the fewest that keep random cells below the limit are taken.
    """
    for agree in range(1, budget + 1):
        blocks = contiguous_bands(n_words, budget + agree)
        bands = [sum(chosen, []) for chosen in itertools.combinations(blocks, agree)]
        if rows >> min(map(len, bands)) <= cell_limit // 8:
            break
    return bands


def permuted_bands(n_words: int, bits: int, rounds: int, seed: int = 7) -> list[list[int]]:
    """Bands of ``bits`` bits from ``rounds`` seeded permutations of all bits."""
    rng, out = random.Random(seed), []
    for _ in range(rounds):
        order = list(range(64 * n_words))
        rng.shuffle(order)
        out += [order[a : a + bits] for a in range(0, len(order) - bits + 1, bits)]
    return out


#: Columns that go with a row, beside fp and rep, where a table has them.
_EXTRA = {"part": "long", "wide": "binary"}


def _carried(rows: DataFrame) -> list[str]:
    return ["fp", "rep", *(c for c in _EXTRA if c in rows.columns)]


def _cells(classes: DataFrame, bands: list[list[int]]) -> DataFrame:
    """A row for each fingerprint and band: (band, cell, fp, rep), and what else a row carries."""
    carried = _carried(classes)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            bits = np.unpackbits(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(n, -1), axis=1)
            for b, band in enumerate(bands):
                cell = bits[:, band].astype(np.int64) @ (np.int64(1) << np.arange(len(band), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, b, np.int32)), pa.array(cell), *batch.columns], names=["band", "cell", *carried])

    return classes.select(carried).mapInArrow(run, "band int, cell long, fp binary, rep long" + "".join(f", {c} {_EXTRA[c]}" for c in carried[2:]))


class _Forest:
    """Components of 0..n-1, labelled by their smallest member; ``spans`` gets the pairs that made them grow together."""

    def __init__(self, n: int, spans=None):
        self.label = np.arange(n)
        self.spans = spans
        self._changes = None

    def union(self, i: np.ndarray, j: np.ndarray) -> None:
        if not len(i):
            return
        while True:
            a, b = self.label[i], self.label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            high, low = np.maximum(a, b), np.minimum(a, b)
            order = np.lexsort((low, high))
            first = order[np.concatenate(([True], high[order[1:]] != high[order[:-1]]))]  # each root hangs below one smaller root
            if self.spans is not None:
                self.spans(i[first], j[first])
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up
            self.label = parent[self.label]
            self._changes = None

    def one(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Whether each range [lo, hi) lies in one component."""
        if self._changes is None:
            self._changes = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))
        return self._changes[hi - 1] == self._changes[lo]


def trie_forest(
    keys: np.ndarray, ranges: np.ndarray, budget: int | tuple[int, ...], leaf: int = 1024, parts: np.ndarray | None = None, emit=None, spans=None,
    wide: np.ndarray | None = None, wide_budget: int | tuple[int, ...] = 0,
) -> np.ndarray:
    """Component label of each row of ``keys`` (n x words, uint64), linked where at most ``budget`` bits differ.

    ``ranges`` has a row (lo_a, hi_a, lo_b, hi_b) for each pair of tries to join; keys are sorted within each range. Of several rising budgets
    the last counts; the others only make close pairs link before wide ones. Rows of one part are linked from the start. With ``wide``
    sketches a pair must be within ``wide_budget`` bits of these too, and they give the order. ``spans(i, j)`` gets the pairs that linked.
    With ``emit`` nothing is linked: it gets all such pairs of rows of different parts.
    """
    rising = lambda b: (b,) if isinstance(b, int) else tuple(b)
    most, levels = rising(budget)[-1], rising(budget if wide is None else wide_budget)
    n = len(keys)
    forest, ones_before = _Forest(n, spans), {}
    if parts is not None:
        _, at, back = np.unique(parts, return_index=True, return_inverse=True)
        forest.label = at[back]

    def ones(depth: int) -> np.ndarray:
        if depth not in ones_before:
            bit = (keys[:, depth >> 6] >> np.uint64(63 - (depth & 63))) & np.uint64(1)
            ones_before[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int64)))).astype(np.int32)
        return ones_before[depth]

    def compare(f: np.ndarray) -> None:
        """All key pairs of these node pairs, a bounded number at a time; of those, close ones link before wide ones."""
        width = f[:, 3] - f[:, 2]
        sizes = (f[:, 1] - f[:, 0]) * width
        total = np.concatenate(([0], np.cumsum(sizes)))
        for at in range(0, int(total[-1]), _PAIRS):
            k = np.arange(at, min(at + _PAIRS, int(total[-1])))
            node = np.searchsorted(total, k, side="right") - 1
            k -= total[node]
            i, j = f[node, 0] + k // width[node], f[node, 2] + k % width[node]
            fresh = (i != j) & (forest.label[i] != forest.label[j])
            i, j = i[fresh], j[fresh]
            off = np.zeros(len(i), np.int64)
            for w in range(keys.shape[1]):
                off += np.bitwise_count(keys[i, w] ^ keys[j, w])
            near = off <= most
            i, j, off = i[near], j[near], off[near]
            if wide is not None:
                chunks = range(0, len(i), 1 << 15)
                off = np.concatenate([np.zeros(0, np.int64), *(np.bitwise_count(wide[i[c : c + (1 << 15)]] ^ wide[j[c : c + (1 << 15)]]).sum(axis=1, dtype=np.int64) for c in chunks)])
            if emit is not None:
                emit(i[off <= levels[-1]], j[off <= levels[-1]])
                continue
            for level in levels:
                forest.union(i[off <= level], j[off <= level])

    stack = [(0, np.column_stack((ranges, np.zeros(len(ranges), np.int64))))] if len(ranges) else []
    while stack:
        depth, f = stack.pop()
        done = forest.one(f[:, 0], f[:, 1]) & forest.one(f[:, 2], f[:, 3]) & (forest.label[f[:, 0]] == forest.label[f[:, 2]])
        f = f[~done]
        small = ((f[:, 1] - f[:, 0]) * (f[:, 3] - f[:, 2]) <= leaf) | (depth == 64 * keys.shape[1])
        compare(f[small])
        f = f[~small]
        if not len(f):
            continue
        c = ones(depth)
        mid_a, mid_b = f[:, 1] - (c[f[:, 1]] - c[f[:, 0]]), f[:, 3] - (c[f[:, 3]] - c[f[:, 2]])
        same = (f[:, 0] == f[:, 2]) & (f[:, 1] == f[:, 3])
        pieces = []
        for a, b in ((0, 1), (1, 0), (1, 1), (0, 0)):
            child = f.copy()
            child[:, 0 if a else 1] = mid_a
            child[:, 2 if b else 3] = mid_b
            child[:, 4] += a != b
            keep = (child[:, 0] < child[:, 1]) & (child[:, 2] < child[:, 3]) & (child[:, 4] <= most)
            if (a, b) == (1, 0):
                keep &= ~same
            pieces.append(child[keep])
        children = np.concatenate(pieces)
        children = children[np.argsort((children[:, 0] == children[:, 2]).astype(np.int8), kind="stable")]
        for at in range(0, len(children), _PAIRS // 4):
            stack.append((depth + 1, children[at : at + _PAIRS // 4]))
    return forest.label


def _joined(items: DataFrame, n_words: int, budget: int | tuple[int, ...], batch_rows: int, every: bool, wide_budget: int | tuple[int, ...], bands: list[list[int]]) -> DataFrame:
    """(a, b) near pairs of representatives: those that span the components of parts within each item, or every one across parts.

    Of the bands in which a pair agrees only the first tells of it where every pair is wanted.
    """
    carried = _carried(items)

    def links(rows: pa.Table):
        keys = np.frombuffer(b"".join(rows.column("fp").to_pylist()), ">u8").reshape(-1, n_words).astype(np.uint64)
        rep = rows.column("rep").to_numpy()
        item = np.column_stack([rows.column(c).to_numpy() for c in ("band", "cell", "x", "y", "depth", "err")])
        side = rows.column("side").to_numpy()
        order = np.lexsort([*(keys[:, w] for w in reversed(range(n_words))), side, *(item[:, c] for c in range(item.shape[1]))])
        keys, rep, item, side = keys[order], rep[order], item[order], side[order]
        new = np.concatenate(([True], (item[1:] != item[:-1]).any(axis=1)))
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(rep))
        mid = lo + np.add.reduceat((side == 0).astype(np.int64), lo)
        own = item[lo, 2] == item[lo, 3]
        ranges = np.where(own[:, None], np.column_stack((lo, hi, lo, hi)), np.column_stack((lo, mid, mid, hi)))
        ranges = ranges[(ranges[:, 0] < ranges[:, 1]) & (ranges[:, 2] < ranges[:, 3])]
        column = lambda c: rows.column(c).take(pa.array(order)) if c in carried else None
        parts, wide = column("part"), column("wide")
        wide = None if wide is None else np.frombuffer(b"".join(wide.to_pylist()), np.uint64).reshape(len(rep), -1)
        found = [np.empty((0, 2), np.int64)]

        def take(i, j):
            if every and len(i):
                bits = np.unpackbits((keys[i] ^ keys[j]).astype(">u8").view(np.uint8), axis=1)
                for b, band in enumerate(bands[:-1]):
                    later = item[i, 0] > b
                    if later.any():
                        stays = ~(later & ~bits[:, band].any(axis=1))
                        i, j, bits = i[stays], j[stays], bits[stays]
            found.append(np.column_stack((rep[i], rep[j])))

        trie_forest(keys, ranges, budget, parts=None if parts is None else parts.to_numpy(), wide=wide, wide_budget=wide_budget, **{"emit" if every else "spans": take})
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 1]), pa.array(pairs[:, 0])], names=["a", "b"])

    def run(batches):
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count < batch_rows:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            names = ("band", "cell", "x", "y", "depth", "err")
            last = [rows.column(c)[-1].as_py() for c in names]
            same = np.logical_and.reduce([rows.column(c).to_numpy() == v for c, v in zip(names, last)])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield links(rows.slice(0, cut))
                rows = rows.slice(cut)
            held, count = rows.combine_chunks().to_batches(), rows.num_rows
        if count:
            yield links(pa.Table.from_batches(held))

    return items.select("band", "cell", "x", "y", "depth", "err", "side", *carried).mapInArrow(run, "a long, b long")


ITEM = ["band", "cell", "x", "y", "depth", "err"]


def _taken_apart(items: DataFrame, budget: int, n_words: int) -> DataFrame:
    """The items one step of four bits deeper: pairs of children whose differing bits stay within the budget."""
    nibble = F.conv(F.substring(F.hex("fp"), F.col("depth") / 4 + 1, F.lit(1)), 16, 10).cast("long")
    near = F.expr("err + bit_count(nib ^ other)") <= budget
    own = F.col("x") == F.col("y")
    wide = items.withColumn("nib", nibble).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(15).cast("long")))).where(near)
    first = F.when(own, F.least("nib", "other")).when(F.col("side") == 0, F.col("nib")).otherwise(F.col("other"))
    second = F.when(own, F.greatest("nib", "other")).when(F.col("side") == 0, F.col("other")).otherwise(F.col("nib"))
    child = lambda up, nib: F.xxhash64(up, nib)
    side = F.when(own, (F.col("nib") > F.col("other")).cast("int")).otherwise(F.col("side"))
    return wide.select(
        "band", "cell", child("x", first).alias("x"), child("y", second).alias("y"),
        (F.col("depth") + 4).cast("int").alias("depth"), F.expr("cast(err + bit_count(nib ^ other) as int)").alias("err"), side.cast("int").alias("side"), *_carried(items),
    )


def near_links(
    classes: DataFrame, budget: int | tuple[int, ...], bands: list[list[int]], n_words: int, cell_limit: int = 100_000, batch_rows: int = 100_000,
    every: bool = False, wide_budget: int | tuple[int, ...] = 0,
) -> DataFrame:
    """Near pairs (a, b) of representatives, the larger first, that span every component of fingerprints within ``budget`` bits.

    ``classes`` holds different fingerprints: (fp binary, rep long). With a column part (long), fingerprints may repeat, and rows of one
    part count as linked. With a column wide (binary), pairs must be within ``wide_budget`` bits of that too. With ``every``, all such pairs
    across parts come, once each if no cell is hot. Of several rising budgets the last one counts, and the others make close pairs come first.
    """
    most = budget if isinstance(budget, int) else max(budget)
    zero = F.lit(0).cast("long")
    items = _cells(classes, bands).select("band", "cell", zero.alias("x"), zero.alias("y"), F.lit(0).alias("depth"), F.lit(0).alias("err"), F.lit(0).alias("side"), *_carried(classes))
    parts = []
    hot = items.groupBy(ITEM).count().where(F.col("count") > cell_limit).select(ITEM)
    while items is not None:
        hot = materialize(hot, "hot")
        depth_left = not hot.isEmpty() and hot.first()["depth"] < 64 * n_words
        calm = items.join(hot, ITEM, "left_anti") if depth_left else items
        parts.append(_joined(calm.repartition(*ITEM).sortWithinPartitions(*ITEM, "side"), n_words, budget, batch_rows, every, wide_budget, bands))
        if not depth_left:
            break
        items = materialize(_taken_apart(items.join(hot, ITEM, "left_semi"), most, n_words), "apart")
        both = F.max("side") - F.min("side")
        lone = F.col("x") != F.col("y")
        sizes = items.groupBy(ITEM).agg(F.count("*").alias("count"), both.alias("sides"))
        items = items.join(sizes.where(lone & (F.col("sides") == 0)).select(ITEM), ITEM, "left_anti")
        hot = sizes.where((F.col("count") > cell_limit) & (~lone | (F.col("sides") > 0))).select(ITEM)
    links = parts[0]
    for part in parts[1:]:
        links = links.union(part)
    return links


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4, budget: int = 4,
    n_words: int = 1, bands: list[list[int]] | None = None, cell_limit: int = 100_000,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Documents whose fingerprints differ in at most ``budget`` bits are linked; component_id is the smallest id reachable.
    Equal fingerprints form one class first, so copies are never expanded into pairs. Null and empty texts have the
    fingerprint zero and are linked like any other. Rows that repeat an id each get a row. A row with a null id links others and gets
    the component of its fingerprint; where every row of a component has a null id, component_id is null. An empty table gives an
    empty result; other columns are not read.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, shingle_words, n_words), "simhash")
    grouped = prints.groupBy("fp").agg(F.min("id").alias("id"))
    classes = materialize(grouped.withColumn("rep", F.monotonically_increasing_id()), "classes")
    bands = bands or lossless_bands(n_words, budget, classes.count(), cell_limit)
    roots = component_roots(near_links(classes.select("fp", "rep"), budget, bands, n_words, cell_limit), "a", "b")
    linked = materialize(classes.join(roots, classes["rep"] == roots["u"], "left").select("fp", "id", F.coalesce("root", "rep").alias("part")), "linked")
    smallest = linked.groupBy("part").agg(F.min("id").alias("component_id"))
    named = linked.join(smallest, "part").select("fp", "component_id")
    return prints.join(named, "fp", "left").select(F.col("id").alias("doc_id"), F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


#: For 5-word shingles at a similarity of 0.8: of 256 bits 39 (deviation 5.7) differ on average, at 0.7 49 and at 0.6 59. The budget lies
#: over three deviations above 0.8; smaller ones go first, so that likely links are proposed before unlikely ones.
SIMILAR = {"shingle_words": 5, "n_words": 4, "budget": (24, 36, 46, 58)}
#: A longer fingerprint, for groups that the first proposals leave torn: of 2048 bits 310 (16) differ at 0.8, 393 at 0.7.
WIDE_WORDS, WIDE_BUDGET = 32, (270, 290, 310, 330, 366)
#: Share of bits that differ at 0.8, and how many bands are expected to agree there.
DIFFER, AGREEING = 0.151, 9


def similar_bands(rows: int, n_words: int = 4) -> list[list[int]]:
    """Bands with the same recall for any number of rows: cells of 256 rows or so, and as many as make AGREEING bands agree at a similarity of 0.8."""
    bits = max(8, math.ceil(math.log2(max(rows, 1) / 256)))
    count = math.ceil(AGREEING / (1 - DIFFER) ** bits)
    each = 64 * n_words // bits
    return permuted_bands(n_words, bits, -(-count // each))[:count]


#: Up to this size similar sets differ by one shingle if at all, and are found without fingerprints, which are poor for so few votes.
SMALL_SET = 8


def shingle_set(text: bytes | None, shingle_words: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles, made of the hashes of their words; words and short texts as in ``fingerprint``.

    Empty without words.
    """
    words = (text or b"").lower().split()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return np.unique(window_hashes(hashes, min(shingle_words, len(words)))) if words else hashes


def set_fingerprint(hashes: np.ndarray, n_words: int = 4) -> bytes:
    """SimHash of a set: every different shingle has one vote."""
    ones = np.zeros(64 * n_words, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        for w in range(n_words):
            bits = np.unpackbits(_remixed(hashes[at : at + _BLOCK], w).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones[64 * w : 64 * w + 64] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits((2 * ones > len(hashes)).reshape(n_words, 64)[:, ::-1], axis=1).tobytes()


def _digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _set_rows(docs: DataFrame, shingle_words: int, n_words: int) -> DataFrame:
    """(id, digest, n, fp, less) of (id, t) rows. ``less`` holds the digests of a small set without one of its shingles each."""

    def run(batches):
        for part in _small(batches):
            sets = [shingle_set(x.as_py(), shingle_words) for x in pc.cast(part.column(1), pa.binary())]
            sizes, prints = pa.array([len(x) for x in sets], pa.int64()), pa.array([set_fingerprint(x, n_words) for x in sets], pa.binary())
            less = pa.array([[_digest(np.delete(x, k)) for k in range(len(x))] if 5 <= len(x) <= SMALL_SET else [] for x in sets], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(map(_digest, sets), pa.binary()), sizes, prints, less], names=["id", "digest", "n", "fp", "less"])

    return docs.mapInArrow(run, "id long, digest binary, n long, fp binary, less array<binary>")


def _sets(docs: DataFrame, shingle_words: int, wide_words: int = 0) -> DataFrame:
    """(digest, hashes array<long>) of (id, t) rows, or (digest, wide binary) with a fingerprint of so many words."""

    def run(batches):
        for part in _small(batches):
            sets = [shingle_set(x.as_py(), shingle_words) for x in pc.cast(part.column(1), pa.binary())]
            found = pa.array([set_fingerprint(x, wide_words) for x in sets], pa.binary()) if wide_words else pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(map(_digest, sets), pa.binary()), found], names=["digest", name])

    name, kind = ("wide", "binary") if wide_words else ("hashes", "array<long>")
    return docs.mapInArrow(run, f"digest binary, {name} {kind}")


def _small(batches):
    """Slices of few rows: their sets are held together."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield batch.slice(at, 256)


def _near(common, n_a, n_b):
    """A Jaccard similarity of 0.8 or more, in whole numbers."""
    return 5 * common >= 4 * (n_a + n_b - common)


def _verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, shingle_words: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose shingle sets are similar; only the texts of these pairs are read."""
    named = classes.select("rep", "digest", "n", "id")
    sized = pairs.join(named.select(F.col("rep").alias("a"), F.col("n").alias("n_a")), "a").join(named.select(F.col("rep").alias("b"), F.col("n").alias("n_b")), "b")
    pairs = materialize(sized.where(_near(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b"))), "candidates")
    needed = materialize(named.join(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "rep"), "needed")
    found = _sets(texts.join(needed.select("id").distinct(), "id", "left_semi"), shingle_words)
    # An id may stand at several texts: the digest tells which of them is meant.
    sets = materialize(needed.select("rep", "digest").join(found, "digest").dropDuplicates(["rep"]).select("rep", "hashes"), "sets")
    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("hashes").alias("y")), "b")
    return both.where(_near(F.size(F.array_intersect("x", "y")), F.col("n_a"), F.col("n_b"))).select("a", "b")


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, n_words: int = 4, budget: int | tuple[int, ...] = SIMILAR["budget"],
    bands: list[list[int]] | None = None, cell_limit: int = 100_000, first_bands: int = 8,
) -> DataFrame:
    """(id, component_id) of every row: components of links between shingle sets with a Jaccard similarity of 0.8 or more.

    The trie join only proposes links and each is held against the sets. Equal sets are one class. Proposals span the components
    of near fingerprints, a row for each class and band at most: first in a few bands, then, with what was confirmed linked from the start,
    in all others. Where a refused proposal leaves a group of near fingerprints torn, its classes get a longer fingerprint, and all
    pairs across its parts that are close by both are checked; pairs within a part never are.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    prints = materialize(_set_rows(texts, shingle_words, n_words), "shingles")
    grouped = prints.groupBy("digest").agg(F.min("id").alias("id"), F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("less").alias("less"))
    classes = materialize(grouped.withColumn("rep", F.monotonically_increasing_id()), "classes")
    nodes = classes.where("id is not null")
    bands = bands or similar_bands(classes.count(), n_words)
    # Classes with the same fingerprint are proposed to each other through the smallest.
    one = nodes.groupBy("fp").agg(F.min("rep").alias("b"))
    same = nodes.select("fp", F.col("rep").alias("a")).join(one, "fp").where("a <> b").select("a", "b")
    larger = nodes.where(F.size("less") > 0).select(F.col("rep").alias("a"), F.explode("less").alias("digest"))
    small = larger.join(nodes.where(F.col("n") < SMALL_SET).select("digest", F.col("rep").alias("b")), "digest").select("a", "b")
    ordered = lambda pairs: pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    in_parts = lambda rows, roots: rows.join(roots, rows["rep"] == roots["u"], "left").withColumn("part", F.coalesce("root", "rep"))

    tried = materialize(ordered(near_links(nodes.select("fp", "rep"), budget, bands[:first_bands], n_words, cell_limit).union(same).union(small)), "tried")
    links = materialize(_verified(tried, classes, texts, shingle_words), "verified")
    roots = component_roots(links, "a", "b")
    if bands[first_bands:]:
        rows = in_parts(nodes.select("fp", "rep"), roots).select("fp", "rep", "part")
        more = materialize(ordered(near_links(rows, budget, bands[first_bands:], n_words, cell_limit)).join(tried, ["a", "b"], "left_anti"), "more")
        if not more.isEmpty():
            good = materialize(_verified(more, classes, texts, shingle_words), "verified")
            tried, links = tried.union(more), links.union(good)
            roots = roots if good.isEmpty() else component_roots(links, "a", "b")
    # A refused pair whose ends are not linked otherwise may hide links: the whole group of near fingerprints around it is looked at again.
    side = lambda c: roots.select(F.col("u").alias(c), F.col("root").alias(f"root_{c}"))
    apart = lambda pairs: pairs.join(side("a"), "a", "left").join(side("b"), "b", "left").where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    torn = materialize(apart(tried.join(links, ["a", "b"], "left_anti")).distinct(), "torn")
    if not torn.isEmpty():
        parts = torn.select(F.explode(F.array("a", "b")).alias("part")).distinct()
        open_ = materialize(in_parts(nodes.select("fp", "rep", "digest", "id"), roots).join(parts, "part", "left_semi").select("fp", "rep", "part", "digest", "id"), "open")
        sketches = _sets(texts.join(open_.select("id").distinct(), "id", "left_semi"), shingle_words, WIDE_WORDS)
        rows = materialize(open_.join(sketches, "digest").dropDuplicates(["rep"]).select("fp", "rep", "part", "wide"), "wide")
        wide_bands = similar_bands(rows.count(), n_words)
        for every in (False, True):  # what spans by the longer fingerprint first; then all pairs that are left across parts
            left = materialize(ordered(near_links(rows, budget, wide_bands, n_words, cell_limit, every=every, wide_budget=WIDE_BUDGET)).join(tried, ["a", "b"], "left_anti"), "left")
            tried, links = tried.union(left), links.union(materialize(_verified(left, classes, texts, shingle_words), "verified"))
            roots = component_roots(links, "a", "b")
            if not every:
                rows = materialize(in_parts(rows.drop("part"), roots).select("fp", "rep", "part", "wide"), "wide")
    named = materialize(classes.join(roots, classes["rep"] == roots["u"], "left").select("digest", "id", F.coalesce("root", "rep").alias("part")), "named")
    smallest = named.groupBy("part").agg(F.min("id").alias("component_id"))
    return prints.select("id", "digest").join(named.join(smallest, "part").select("digest", "component_id"), "digest").select("id", "component_id")


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows that are near duplicates of a row that stays; of each group the smallest id stays.

    Rows with a null id stay. Repeated rows of the id that stays all stay (they are exact dedup's work). Columns are as before.
    """
    found = similar_groups(docs, id_col, text_col, **(SIMILAR | settings))
    dropped = found.where("component_id <> id").select(F.col("id").alias(id_col)).distinct()
    return docs.join(dropped, id_col, "left_anti").select(docs.columns)
