"""Byte-level BPE encoding and decoding of a text column."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiforge.llm.tokens import encoder


def encoded(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, decoded binary) of every row; null text counts as empty.

    An empty text has no ids. Repeated rows and null ids each give a row; other columns are not read; an empty table
    gives an empty result. Invalid code points cannot occur in a Spark string that came from UTF-8.
    """
    return _run(docs, path, pattern, id_col, text_col, False)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of what ``encoded`` gives, made where it is made."""
    return _run(docs, path, pattern, id_col, text_col, True)


def _run(docs, path, pattern, id_col, text_col, digest):
    def run(batches):
        bpe = encoder(path, pattern)
        for batch in batches:
            first, second, third = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "").tolist()
                data = bpe.decode(ids)
                if digest:
                    first.append(len(ids))
                    second.append(hashlib.sha256(" ".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest())
                    third.append(hashlib.sha256(data).hexdigest())
                else:
                    first.append(ids)
                    third.append(data)
            columns = [pa.array(first, pa.int64()), pa.array(second, pa.string()), pa.array(third, pa.string())] if digest else [pa.array(first, pa.list_(pa.int32())), pa.array(third, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<int>, decoded binary"
    names = [x.split(" ")[0] for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t")).mapInArrow(run, schema)
