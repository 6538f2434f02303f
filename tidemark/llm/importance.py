"""Draw the documents that look most like a target corpus, by hashed n-gram importance weights.

Features are the words of a text and its pairs of neighbouring words, hashed to ``BUCKETS``
buckets. A bucket's gain is the log ratio of its smoothed share in the target and in the corpus;
a document's weight is the mean gain of its features. Gumbel noise from a hash of the id is added,
so the highest scores are a draw without replacement in proportion to the weights.

Texts are worked on many at a time: a slice of them is joined with a separator byte that no word
holds, one regular expression pass finds all words, ``searchsorted`` in the texts' offsets tells
whose they are, and word pairs that reach over two texts are masked before all buckets are
counted at once. A text longer than ``SLICE`` bytes goes through in pieces that overlap by a
word. Both passes read whole texts and shuffle no text: the first gives each task's bucket
counts (at most ``BUCKETS`` rows a task), the second one narrow row per document. The ranks come
from range partitions of the scores, numbered block by block.

Defined cases: a null text has no words and weight 0, as has an empty one; a null doc_id is
hashed as an empty text and drawn after other ids at equal scores; rows that repeat an id get the
same noise and ranks of their own; extra columns are ignored; an empty corpus gives no rows, and
an empty target makes all gains depend on the corpus alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import durable
from tidemark.operators.scan import Running, cut, running

BUCKETS = 10_000
SEED = 7
PERCENT = 25
LEAST_WORDS = 20
SLICE = 1 << 20
# All but white space, signs and capital letters of ASCII: bytes of other letters belong to words.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEPARATOR = b"\0"
_INSIDE = bytes(b for b in range(256) if WORD.match(bytes([b])))
_BETWEEN = bytes(set(range(256)) - set(_INSIDE))


@dataclass
class Features:
    """Buckets of the features of some texts, with the number of each one's text."""

    text: np.ndarray
    bucket: np.ndarray
    words: np.ndarray  # of each text


def _pieces(texts: pa.Array, size: int) -> Iterator[tuple[int, bytes, bool]]:
    """Row, lower-case bytes, and whether the first word was already in the piece before."""
    for row, text in enumerate(texts.cast(pa.large_binary())):
        data = (text.as_py() or b"").lower()
        begin, again = 0, False
        while len(data) - begin > size:
            filled = data[begin : begin + size].rstrip(_BETWEEN)
            if not filled:
                begin += size
                continue
            last = begin + len(filled.rstrip(_INSIDE))
            if last == begin:  # one word fills the piece; it goes together with the next word
                after = WORD.search(data, WORD.match(data, begin).end())
                if after is None:
                    break
                last = after.start()
            yield row, data[begin : WORD.match(data, last).end()], again
            begin, again = last, True
        yield row, data[begin:], again


def features(texts: pa.Array, size: int = SLICE) -> Iterator[Features]:
    """The features of a column of texts, about ``size`` bytes at a time."""
    held: list[tuple[int, bytes, bool]] = []
    n = 0
    for piece in _pieces(texts, size):
        held.append(piece)
        n += len(piece[1])
        if n >= size:
            yield _joined(held, len(texts))
            held, n = [], 0
    if held:
        yield _joined(held, len(texts))


def _joined(pieces: list[tuple[int, bytes, bool]], rows: int) -> Features:
    row = np.array([p[0] for p in pieces])
    begin = np.cumsum([0, *(len(p[1]) + 1 for p in pieces[:-1])])
    found = [(m.start(), m[0]) for m in WORD.finditer(SEPARATOR.join(p[1] for p in pieces))]
    start = np.array([s for s, _ in found], dtype=np.int64)
    words = [w for _, w in found]
    one = [crc32(w) for w in words]
    two = [crc32(b" " + w, c) for c, w in zip(one, words[1:])]
    piece = np.searchsorted(begin, start, side="right") - 1
    inside = piece[1:] == piece[:-1]
    repeated = np.array([p[2] for p in pieces])
    first = np.append(True, ~inside)[: len(piece)]
    counted = ~(first & repeated[piece])
    text = row[piece]
    one, two = np.array(one, dtype=np.int64)[counted], np.array(two, dtype=np.int64)[inside]
    return Features(
        np.concatenate([text[counted], text[:-1][inside]]), np.concatenate([one, two]) % BUCKETS,
        np.bincount(text[counted], minlength=rows))


def _task_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for part in features(batch.column(0)):
            total += np.bincount(part.bucket, minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    rows = texts.select("text").mapInArrow(_task_counts, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows.collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, floored."""
    t_all, s_all = float(target.sum()), float(corpus.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS))))
        for t, s in zip(target.astype(float).tolist(), corpus.astype(float).tolist())], dtype=np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> Column:
    """Struct of n_words, n_features and weight of the text column."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    @F.arrow_udf("struct<n_words: long, n_features: long, weight: long>")
    def weigh(texts: pa.Array) -> pa.Array:
        n_words, n, total = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
        for part in features(texts):
            n_words += part.words
            n += np.bincount(part.text, minlength=len(texts))
            total += np.bincount(part.text, shared.value[part.bucket], minlength=len(texts)).astype(np.int64)
        mean = np.where(n > 0, total // np.maximum(n, 1), 0)
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n_words, n, mean)], ["n_words", "n_features", "weight"])

    return weigh(F.col("text"))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel value from a hash of the id, floored."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every document."""
    gain = gains(bucket_counts(target), bucket_counts(docs))
    rows = docs.select("doc_id", weights(docs, gain).alias("w")).select("doc_id", "w.*")
    scored = durable(rows.select(
        "*", (F.col("weight") + noise(F.col("doc_id"))).alias("score"), F.monotonically_increasing_id().alias("row")))
    enough = F.col("n_words") >= least_words
    drawn = scored.where(enough).count() * percent // 100
    order = ["low", "no_id", "doc_id", "row"]
    keyed = scored.where(enough).select("*", (-F.col("score")).alias("low"), F.col("doc_id").isNull().alias("no_id"))
    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = running(cut(keyed, order, blocks), [], order, {"rank": Running("sum", F.lit(1).cast("long"))})
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))
