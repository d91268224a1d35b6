"""Encoding and decoding documents with a byte-level BPE vocabulary.

A null text counts as empty: no tokens, and an empty decoded text. Rows keep
their number and their ids, repeated ones too; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import decode_bytes, encoder, vocabulary
from .frames import documents, per_block


def round_trip(docs: DataFrame, path: str, schema: str, derive: Callable, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode all texts, decode their tokens, and keep what `derive` makes of both.

    derive(ids, offsets, decoded) gets the token ids of a block of texts, the
    texts' offsets in them, and the decoded bytes of each text. It returns the
    columns of `schema` after the id.
    """

    def work(block, rows):
        tokens, at = encoder(path).encode(block)
        data, begin = decode_bytes(vocabulary(path), tokens)
        cut = begin[at].tolist()
        return {id: rows.column(0)} | derive(tokens, at, [data[a:b] for a, b in zip(cut, cut[1:], strict=False)])

    return per_block(documents(docs, id=id, text=text), f"{id} {docs.schema[id].dataType.simpleString()}, {schema}", work, text)


def encode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every text: (id, ids array<int>)."""

    def work(block, rows):
        tokens, at = encoder(path).encode(block)
        return {id: rows.column(0), "ids": pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(tokens, pa.int32()))}

    return per_block(documents(docs, id=id, text=text), f"{id} {docs.schema[id].dataType.simpleString()}, ids array<int>", work, text)


def decode(encoded: DataFrame, path: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of token ids: (id, text). Bytes that aren't UTF-8 become U+FFFD; null ids give an empty text."""

    def run(batches):
        for batch in batches:
            lists = batch.column(1).to_pylist()
            arrays = [np.array([i for i in x or [] if i is not None], np.int64) for x in lists]
            data, begin = decode_bytes(vocabulary(path), np.concatenate(arrays) if arrays else np.zeros(0, np.int64))
            cut = begin[np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int64)].tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:], strict=False)], pa.string())], [id, "text"])

    return encoded.select(id, ids).mapInArrow(run, f"{id} {encoded.schema[id].dataType.simpleString()}, text string")
