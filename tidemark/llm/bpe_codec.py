"""Encode texts to byte-level BPE ids and decode ids to texts, in Arrow batches.

The ids are those of the tokenizers library without special tokens around a text; added tokens
inside a text are found. The method is in ``byte_bpe``: longest tokens are proposed, neighbours
are checked, and words that fail are merged exactly. Nothing is shuffled. The vocabulary file is
read on the driver and shared with the workers, which build their tables once.

A batch is worked on in slices of about ``SLICE`` characters of whole texts, so what a worker
holds beyond a batch and its result follows the longest text.

Defined cases: a null text is empty, and an empty text has no ids; null ids decode to an empty
text; bytes that are no UTF-8 decode to the replacement sign; repeated rows and repeated or null
doc_ids are encoded each; extra columns stay as they are, and a column that has the name of the
result is replaced, as ``withColumn`` does; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import ByteBpe

SLICE = 1 << 20
_made: dict[str, ByteBpe] = {}


class Vocabulary:
    """A vocabulary file for the workers of a session."""

    def __init__(self, docs: DataFrame, path: str, special: bool = True):
        self.special, self.token = special, uuid.uuid4().hex
        self._content: Broadcast = docs.sparkSession.sparkContext.broadcast(Path(path).read_bytes())

    def tables(self) -> ByteBpe:
        """The tables, built once in a worker."""
        if self.token not in _made:
            _made.clear()
            _made[self.token] = ByteBpe(self._content.value, self.special)
        return _made[self.token]


def text_slices(texts: pa.Array, size: int = SLICE) -> Iterator[list[str]]:
    """The texts of a column, null as empty, in lists of about ``size`` characters."""
    held, n = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        n += len(held[-1])
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def int_lists(rows: list[bytes]) -> pa.Array:
    """A list column of the 32-bit integers in each row's bytes."""
    ends = np.cumsum([0, *map(len, rows)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(
        pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(rows))]))


def _encode(tables: ByteBpe, texts: pa.Array) -> pa.Array:
    return int_lists([ids for part in text_slices(texts) for ids in tables.encode(part)])


def _decode(tables: ByteBpe, lists: pa.Array) -> pa.Array:
    out = []
    for at in range(0, len(lists), 256):
        part = lists.slice(at, 256)
        end = np.cumsum(part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        data, token_end = tables.joined(part.flatten().to_numpy(zero_copy_only=False))
        data, token_end = data.tobytes(), np.concatenate([[0], token_end])
        cut = [0, *token_end[end].tolist()]
        out += [data[a:b].decode(errors="replace") for a, b in zip(cut, cut[1:])]
    return pa.array(out, pa.string())


def encoded(vocabulary: Vocabulary, text: Column) -> Column:
    """The ids of a text column as an array."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        return _encode(vocabulary.tables(), texts)

    # Otherwise Spark may copy the call into each use of its result and encode twice.
    return encode.asNondeterministic()(text)


def decoded(vocabulary: Vocabulary, ids: Column) -> Column:
    """The text of an array column of ids."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        return _decode(vocabulary.tables(), lists)

    return decode(ids)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, the ids of its text and the text that they decode to, for every row.

    One worker does both, so a task holds the tables once.
    """
    vocabulary = Vocabulary(docs, path)

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def there_and_back(texts: pa.Array) -> pa.Array:
        ids = _encode(vocabulary.tables(), texts)
        return pa.StructArray.from_arrays([ids, _decode(vocabulary.tables(), ids)], ["ids", "decoded"])

    return docs.select("doc_id", there_and_back(F.col("text")).alias("both")).select("doc_id", "both.ids", "both.decoded")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    return round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
