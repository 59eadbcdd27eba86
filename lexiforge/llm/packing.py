"""Order-preserving packing of token streams into windows of a fixed length.

Each scan partition is a shard of its own, read in order and without a shuffle. Its documents form one token stream; the
places where a window may end are the ends of documents, the ends of sentences and a coarse grid. A dynamic program chooses
the ends that minimise padding plus a penalty for every document or sentence that is cut; the best earlier end within
reach of each place comes from a monotone queue, so the work is linear in the number of places.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.llm.tokens import file_tokenizer

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Tokens that a cut costs, as if they were padding: inside a sentence, and between two sentences of a document.
SENTENCE_CUT, DOCUMENT_CUT = 8, 1
#: Tokens that a sequence costs, as if they were padding: else streams would fall into short sequences of a power of two, which have none.
SEQUENCE = 48
GRID = 64
#: Tokens that are planned at once; what the last window of a plan would hold goes to the next plan.
PLAN = 1 << 18


def plan_cuts(places: list[int], penalty: list[int], window: int, each: int = 0) -> list[int]:
    """Ends of windows over a stream from 0 to places[-1].

    ``places`` rise and no two neighbours (or 0 and the first) are more than ``window`` apart. Minimises the sum of the padding
    and of the penalty of each end, and of ``each`` for every window; of equal plans the one with the longer last windows. Padding is window - length, and none at
    a power of two: besides the best earlier end within reach, which the queue has, those at a power of two are tried.
    """
    best, back = [0] * (len(places) + 1), [0] * (len(places) + 1)
    at = [0, *places]
    index = {x: k for k, x in enumerate(at)}.get
    exact = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    queue = deque([(0, 0)])  # (best + place, index), rising in both
    for k in range(1, len(at)):
        place = at[k]
        while at[queue[0][1]] < place - window:
            queue.popleft()
        low, back[k] = queue[0]
        low += window - place
        for size in exact:
            j = index(place - size)
            if j is not None and best[j] < low:
                low, back[k] = best[j], j
        best[k] = low + each + penalty[k - 1]
        key = best[k] + place
        while queue and queue[-1][0] > key:
            queue.pop()
        queue.append((key, k))
    cuts, k = [], len(places)
    while k:
        cuts.append(at[k])
        k = back[k]
    return cuts[::-1]


class _Shard:
    """Takes documents in order; gives out pieces as soon as their window is sure."""

    def __init__(self, shard: int, window: int, ends_sentence: np.ndarray | None):
        self.window, self.ends_sentence, self.sequence = window, ends_sentence, shard << 33
        self.held: list[tuple[int | None, int, int, np.ndarray]] = []  # id, start, tokens of the document, the rest of its ids
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray):
        self.held.append((doc_id, 0, len(ids), ids))
        self.tokens += len(ids)
        if self.tokens >= PLAN:
            yield from self.flush(False)

    def flush(self, last: bool):
        if not self.held:
            return
        ids = np.concatenate([x[3] for x in self.held])
        doc_ends = np.cumsum([len(x[3]) for x in self.held])
        price = np.full(len(ids) + 1, SENTENCE_CUT, np.int8)
        allowed = np.zeros(len(ids) + 1, bool)
        allowed[GRID::GRID] = True
        if self.ends_sentence is not None:
            after = np.flatnonzero(self.ends_sentence[ids]) + 1
            allowed[after], price[after] = True, DOCUMENT_CUT
        allowed[doc_ends], price[doc_ends] = True, 0
        allowed[0] = False
        places = np.flatnonzero(allowed)
        cuts = plan_cuts(places.tolist(), price[places].tolist(), self.window, SEQUENCE)
        if not last and len(cuts) > 1:  # the end of the plan is no real end: plan its last windows again
            cuts = cuts[: max(1, len(cuts) - 4)]
        k, begin = 0, 0
        for cut in cuts:
            offset = 0
            while begin < cut:
                doc_id, start, total, rest = self.held[k]
                n = min(len(rest), cut - begin)
                yield doc_id, start, n, zlib.crc32(rest[:n].tobytes()), total, self.sequence, offset
                offset, begin = offset + n, begin + n
                if n == len(rest):
                    k += 1
                else:
                    self.held[k] = (doc_id, start + n, total, rest[n:])
            self.sequence += 1
        self.held = self.held[k:]
        self.tokens -= begin


def packed(docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids by the ``tokenizers`` file, then ``end_id``; a null or empty text is that id alone. Each id is in one
    piece; the pieces of a sequence lie at gapless offsets from 0 and fill at most ``window``. Sequences keep the order of
    the scan; their ids are unique and rise within a scan partition. Repeated rows and null ids are packed like any others. An empty
    table gives an empty result; other columns are not read.
    """
    ends = (b".", b"!", b"?", b"\n")

    def run(batches):
        tokens = file_tokenizer(tokenizer)
        of = tokens.token_bytes()
        closing = np.array([x.rstrip(b" ").endswith(ends) for x in of]) if of else None
        if closing is not None and end_id >= len(closing):
            closing = np.append(closing, np.zeros(end_id + 1 - len(closing), bool))
        shard = _Shard(TaskContext.get().partitionId(), window, closing)
        tail = np.array([end_id], "<u4")

        def rows(found):
            columns = list(zip(*found)) or [[]] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                out.extend(shard.add(doc_id, np.concatenate((tokens.encode(text.as_py() or ""), tail))))
            yield rows(out)
        yield rows(list(shard.flush(True)))

    names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, SCHEMA)
