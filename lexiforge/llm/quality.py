"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from whole-passage statistics through a learned layer; gated attention
gives every passage a weight; the weighted sum of the encodings gives the score. All weights are learned from document labels alone,
on the driver, from a bounded sample; scoring is one pass over the text without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASSAGE_WORDS = 48
#: Labelled documents that are learned from at most, chosen by a hash of doc_id among those whose text has at most so many bytes.
TRAINING_DOCS, TRAINING_BYTES = 4000, 1 << 20
THRESHOLD = 0.3

#: Bytes that are looked at together, about. Passages do not depend on it: a longer text is cut only where a passage ends.
BLOCK = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_DIGIT, _UPPER, _TAIL, _LETTER = (np.zeros(256, np.int32) for _ in range(4))
_DIGIT[48:58] = 1
_UPPER[65:91] = 1
_TAIL[0x80:0xC0] = 1  # bytes inside a character
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC0, 256)]] = 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_EVEN = np.uint64(pow(int(_ODD), -1, 1 << 64))


class PassageEncoder:
    """Statistics of each passage of texts, over whole blocks of bytes at once."""

    width = 22

    def __init__(self):
        self._power = self._inverse = np.zeros(0, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self._power):
            of = lambda x: np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(max(n, 2 * BLOCK + 2), x))))
            self._power, self._inverse = of(_ODD), of(_EVEN)
        return self._power[:n], self._inverse

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """For each text passages x width; a text without words is one passage of zeros."""
        parts: list[list[np.ndarray]] = [[] for _ in texts]
        block, owners, size = [], [], 0
        for k, text in enumerate(texts):
            for piece in self._cut(text):
                if block and size + len(piece) > 2 * BLOCK:
                    self._into(parts, block, owners)
                    block, owners, size = [], [], 0
                block.append(piece)
                owners.append(k)
                size += len(piece) + 1
        if block:
            self._into(parts, block, owners)
        out = []
        for text, found in zip(texts, parts):
            x = np.concatenate(found) if found else np.zeros((0, self.width), np.float32)
            if not len(x):
                x = np.zeros((1, self.width), np.float32)
            else:
                lines = [line for line in text.split(b"\n") if line.strip()]
                x[:, 20] = len(set(lines)) / len(lines)
                x[:, 21] = np.log1p(len(text))
            out.append(x)
        return out

    @staticmethod
    def _cut(text: bytes):
        """Pieces that end where a passage does."""
        at, reach = 0, BLOCK
        while len(text) - at > reach:
            space = _SPACE[np.frombuffer(text, np.uint8, reach, at)]
            words = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
            whole = (len(words) - 1) // PASSAGE_WORDS * PASSAGE_WORDS
            if whole <= 0:  # no passage ends here: look further
                reach *= 2
                continue
            yield text[at : at + words[whole]]
            at, reach = at + int(words[whole]), BLOCK
        yield text[at:]

    def _into(self, parts: list[list[np.ndarray]], block: list[bytes], owners: list[int]) -> None:
        x, counts = self._encode(block)
        ends = np.cumsum(counts)
        for k, end, n in zip(owners, ends.tolist(), counts.tolist()):
            if n:
                parts[k].append(x[end - n : end])

    def _encode(self, block: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Passages of all pieces of a block, and how many each piece has."""
        raw = np.frombuffer(b"\n".join(block) + b"\n", np.uint8)
        space = _SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[0::2], edge[1::2]
        n = len(start)
        offsets = np.cumsum([0] + [len(b) + 1 for b in block])
        piece = np.searchsorted(offsets, start, side="right") - 1
        per_piece = np.bincount(piece, minlength=len(block))
        counts = -(-per_piece // PASSAGE_WORDS)
        if not n:
            return np.zeros((0, self.width), np.float32), counts
        first_word = np.cumsum(per_piece) - per_piece
        passage = (np.cumsum(counts) - counts)[piece] + (np.arange(n) - first_word[piece]) // PASSAGE_WORDS

        def within(values: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(values, dtype=np.int32)))
            return (total[end] - total[start]).astype(np.float32)

        wide_upper = np.zeros(len(raw), np.int32)
        wide_upper[:-1] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
        upper_at = _UPPER[raw] + wide_upper
        chars, letters, upper, digits = (end - start) - within(_TAIL[raw]), within(_LETTER[raw]), within(upper_at), within(_DIGIT[raw])
        other = chars - letters - digits
        last, head = raw[end - 1], upper_at[start]
        power, inverse = self._powers(len(raw))
        sums = np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power)
        sums = np.concatenate(([np.uint64(0)], sums))
        word = (sums[end] - sums[start]) * inverse[start]

        starts = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
        size = np.diff(np.append(starts, n)).astype(np.float32)
        add = lambda v: np.add.reduceat(v.astype(np.float32), starts)
        total = np.maximum(add(chars), 1)
        order = np.lexsort((word, passage))
        pw, ww = passage[order], word[order]
        new = np.concatenate(([True], (ww[1:] != ww[:-1]) | (pw[1:] != pw[:-1])))
        groups = np.flatnonzero(new)
        most = np.maximum.reduceat(np.diff(np.append(groups, n)), np.searchsorted(pw[groups], np.arange(len(starts))))
        again = np.concatenate(([False], (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])))
        mean = add(chars) / size
        x = np.zeros((len(starts), self.width), np.float32)
        x[:, 0] = mean
        x[:, 1] = np.sqrt(np.maximum(add(chars**2) / size - mean**2, 0))
        for k, v in enumerate((letters, upper, digits, other)):
            x[:, 2 + k] = add(v) / total
        for k, v in enumerate((last == 46, last == 44, (last == 33) | (last == 63) | (last == 59) | (last == 58), head > 0, (letters > 1) & (upper == letters), letters + digits == 0, (letters > 0) & (chars - letters > 2))):
            x[:, 6 + k] = add(v) / size
        x[:, 13] = add(new) / size
        x[:, 14] = most / size
        x[:, 15] = add(again) / size
        x[:, 16] = np.log1p(size)
        x[:, 17] = (x[:, 6] == 0) & (size > 40)
        x[:, 18] = x[:, 3] > 0.5 * x[:, 2]
        x[:, 19] = x[:, 5] > 0.3
        return x, counts


class AttentionModel:
    """tanh encoding, gated attention over the passages of a bag, logistic score of the weighted sum."""

    def __init__(self, width: int, hidden: int = 24, gate: int = 12, seed: int = 5):
        rng = np.random.default_rng(seed)
        init = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float64)
        self.p = {"W": init(width, hidden), "b": np.zeros(hidden), "V": init(hidden, gate), "U": init(hidden, gate), "w": init(gate), "c": init(hidden), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(width), np.ones(width)

    def _forward(self, x: np.ndarray, starts: np.ndarray):
        p = self.p
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        a = np.exp(e - np.maximum.reduceat(e, starts)[bag])
        a /= np.add.reduceat(a, starts)[bag]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        y = 1 / (1 + np.exp(-(z @ p["c"] + p["d"][0])))
        return h, t, s, bag, a, z, y

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self._forward(x, starts)[-1]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int = 60, batch: int = 128, rate: float = 0.01, decay: float = 1e-4, seed: int = 6) -> AttentionModel:
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), np.maximum(every.std(0), 1e-3)
        rng, p = np.random.default_rng(seed), self.p
        m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                chosen = order[at : at + batch]
                x = np.concatenate([bags[k] for k in chosen]).astype(np.float64)
                starts = np.cumsum([0] + [len(bags[k]) for k in chosen[:-1]])
                h, t, s, bag, a, z, y = self._forward(x, starts)
                u = np.clip((x - self.mean) / self.scale, -8, 8)
                dy = (y - labels[chosen]) / len(chosen)
                dz = dy[:, None] * p["c"]
                da = (dz[bag] * h).sum(1)
                de = a * (da - np.add.reduceat(a * da, starts)[bag])
                dt, ds = de[:, None] * p["w"] * s * (1 - t**2), de[:, None] * p["w"] * t * s * (1 - s)
                dh = (a[:, None] * dz[bag] + dt @ p["V"].T + ds @ p["U"].T) * (1 - h**2)
                g = {"W": u.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": z.T @ dy, "d": np.array([dy.sum()])}
                step += 1
                pace = rate * (1 - epoch / epochs)
                for k in p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    p[k] -= pace * (m[k] / (1 - 0.9**step) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8) + decay * p[k])
        return self


class _Constant:
    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.full(len(starts), self.share)


def held_out(doc_id: Column) -> Column:
    """Whether a document is for testing: crc32 of its id as text leaves 0 modulo 5; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", training_docs: int = TRAINING_DOCS) -> AttentionModel | _Constant:
    """A model of P(label = 1) from documents that are not held out.

    Null labels and ids are not learned from; of labels that contradict each other the larger counts. With one class only, the
    score is its share; with no labelled document, 1.
    """
    known = labels.where(~held_out(F.col(id_col)) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("__y"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(training_docs)

    def encode(batches: Iterator[pa.RecordBatch]):
        encoder = PassageEncoder()
        for batch in batches:
            rows = []
            for x in encoder([t or b"" for t in pc.cast(batch.column(2), pa.binary()).to_pylist()]):
                rows.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["id", "y", "x"])

    text = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__t")).where(F.coalesce(F.octet_length("__t"), F.lit(0)) <= TRAINING_BYTES)
    sample = text.join(F.broadcast(chosen), "__id").select(F.xxhash64("__id").alias("id"), "__y", "__t").mapInArrow(encode, "id long, y int, x binary").collect()
    sample.sort(key=lambda r: (r.id, r.x))
    sample = sample[: 2 * training_docs]  # part of the bound: ids that many rows repeat
    y = np.array([r.y for r in sample], float)
    if len(set(y)) < 2:
        return _Constant(float(y.mean()) if len(y) else 1.0)
    return AttentionModel(PassageEncoder.width).fit([np.frombuffer(r.x, np.float32).reshape(-1, PassageEncoder.width) for r in sample], y)


def score_column(model: AttentionModel | _Constant, text: Column) -> Column:
    """Scores of whole texts; null counts as empty."""

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = PassageEncoder()
        for texts in parts:
            out = []
            for at in range(0, len(texts), 256):
                bags = encoder([t or b"" for t in pc.cast(texts.slice(at, 256), pa.binary()).to_pylist()])
                out.append(model.score(np.concatenate(bags), np.cumsum([0] + [len(b) for b in bags[:-1]])))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))

    return score(text.cast("string"))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; predicted is 1 from ``threshold``.

    Only texts are inputs of a score; empty and null texts are scored too. Repeated rows and null ids each give a row; an empty
    table gives an empty result; other columns are not read.
    """
    model = train(docs, labels, id_col, text_col)
    return docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), score_column(model, F.col(text_col)).alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, columns as before."""
    model = train(docs, labels, id_col, text_col)
    return docs.where(score_column(model, F.col(f"`{text_col}`")) >= threshold)
