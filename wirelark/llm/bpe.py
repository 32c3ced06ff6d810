"""Operator 2: byte pair encoding by a segment tree over adjacent pair ranks, and decoding.

A narrow map: no shuffle, memory bounded by an Arrow batch and the word cache, and any task can be run again.
Null and empty texts give no ids. Repeated rows give repeated rows; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import texts
from .tokens import default_tokenizer, segment_tree_bpe


def encode(docs: DataFrame, path: str | None = None, *, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds (or replaces) the column ``ids``: array of ids of the whole text."""
    path = path or default_tokenizer()
    keep = docs.drop(ids)
    schema = StructType([*keep.schema.fields, StructField(ids, ArrayType(IntegerType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = segment_tree_bpe(path)
        for part, rows in texts(batches, text):
            raw = [np.frombuffer(bpe.encode(t), "<u4").astype(np.int32) for t in rows]
            ends = np.cumsum([0, *map(len, raw)], dtype=np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *raw])))
            yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, ids])

    return keep.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str | None = None, *, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds (or replaces) the column ``text``: the tokens of the ids joined as the vocabulary's decoder does; null stays null."""
    path = path or default_tokenizer()
    keep = rows.drop(text)
    schema = StructType([*keep.schema.fields, StructField(text, StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = segment_tree_bpe(path)
        for part, lists in texts(batches, ids):
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([None if x is None else bpe.decode(x) for x in lists], pa.string())], names=[*part.schema.names, text])

    return keep.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_tokens, SHA-256 of the ids and of the text decoded from them. Encodes and decodes in one pass."""
    path = path or default_tokenizer()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = segment_tree_bpe(path)
        sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
        for part, rows in texts(batches):
            n, a, b = [], [], []
            for t in rows:
                ids = np.frombuffer(bpe.encode(t), "<u4").tolist()
                n.append(len(ids))
                a.append(sha(" ".join(map(str, ids))))
                b.append(sha(bpe.decode(ids)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
