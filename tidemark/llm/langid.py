"""Language by compression: the language whose dictionary makes a text smallest.

Texts are put in lower case and what stands between letters becomes one space. For each language
a sample of training texts becomes a raw-content zstandard dictionary. Every
whole text is cut at spaces into slices of at most ``SLICE`` bytes, and each slice is compressed
by itself with each dictionary: in one long frame the text's own history takes the place of the
dictionary, and the beginning would decide. The smallest sum of sizes names the language, and the
score is the share by which it beats the second (0 if they tie). ``reliable`` is false where
that margin is below ``NARROW``. Ties go to the language that sorts first.

The sample takes, per language, ``TEXTS`` different training texts chosen by a hash, of each a
piece of at most ``PIECE`` characters at a place that the hash draws from the whole text, so a dictionary has a fixed bound and the number of languages bounds
what is collected. Texts are then compressed where they lie; nothing is shuffled.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with no training
text every text is ``und``; with one language every text with a letter gets it, score 1;
repeated rows are judged each; other columns are ignored; null ids take part as texts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TEXTS = 96
PIECE = 2000
SLICE = 4096
SPARE = 4
LEVEL = 3
NARROW = 0.01
FOLDS, HELD = 4, 2
UNKNOWN = "und"


def letters(text: Column) -> Column:
    """The words of a text in lower case, apart by one space; empty where there is no letter."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{M}]+", " "))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD, F.lit(False))


def training_texts(docs: DataFrame, texts: int = TEXTS, piece: int = PIECE) -> DataFrame:
    """(lang, h, part): the sampled pieces, those of the lowest text hashes.

    A first cut at a hash value, from the number of different texts of each language, leaves about
    ``SPARE`` times as many as are wanted, so that a large language is not ranked in one task.
    """
    known = docs.where(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")
    ).select("lang", F.xxhash64("text").alias("h"), "text")
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()
    cuts = [F.when(F.col("lang") == r.lang, -(2**63) + min(2**64 - 1, 2**64 * SPARE * texts // r.n)) for r in sizes]
    few = known.where(F.col("h") <= F.coalesce(*cuts)) if cuts else known.limit(0)
    spelled = few.select("lang", "h", letters(F.col("text")).alias("letters"))
    start = 1 + F.pmod("h", F.greatest(F.lit(1), F.length("letters") - piece + 1))
    parts = spelled.select("lang", "h", F.substr("letters", start.cast("int"), F.lit(piece)).alias("part"))
    order = Window.partitionBy("lang").orderBy("h")
    ranked = parts.dropDuplicates(["lang", "h"]).withColumn("r", F.row_number().over(order))
    return ranked.where(F.col("r") <= texts).select("lang", "h", "part")


def dictionaries(docs: DataFrame, texts: int = TEXTS, piece: int = PIECE) -> dict[str, bytes]:
    """The raw content of each language's dictionary."""
    parts: dict[str, list] = {}
    for row in training_texts(docs, texts, piece).collect():
        parts.setdefault(row.lang, []).append((row.h, row.part))
    return {lang: "\n".join(p for _, p in sorted(parts[lang])).encode() for lang in sorted(parts)}


def slices(text: bytes, size: int = SLICE) -> Iterator[memoryview]:
    """The whole text in slices that end at a space; a longer run without one is cut at the size."""
    held, start = memoryview(text), 0
    while len(text) - start > size:
        space = text.rfind(b" ", start, start + size)
        end = space + 1 if space > start else start + size
        yield held[start:end]
        start = end
    yield held[start:]


class Compressors:
    """One compressor per language, made once in a worker."""

    def __init__(self, contents: dict[str, bytes]):
        self.langs = list(contents)
        self.made = []
        for content in contents.values():
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=LEVEL)
            self.made.append(zstandard.ZstdCompressor(
                dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list[int]:
        totals = [0] * len(self.made)
        for part in slices(text):
            for k, c in enumerate(self.made):
                totals[k] += len(c.compress(part))
        return totals

    def judge(self, text: bytes) -> tuple[str, float]:
        if not self.made or not text:
            return UNKNOWN, 0.0
        sizes = self.sizes(text)
        best = int(np.argmin(sizes))
        rest = [s for k, s in enumerate(sizes) if k != best]
        return self.langs[best], 1 - sizes[best] / min(rest) if rest else 1.0


_made: dict[str, Compressors] = {}


def identify(docs: DataFrame, contents: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """doc_id, held_out, lang_pred, score, reliable of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    token = uuid.uuid4().hex

    @F.arrow_udf("struct<lang: string, score: double>")
    def judged(text: pa.Array) -> pa.Array:
        if token not in _made:
            _made.clear()
            _made[token] = Compressors(shared.value)
        judge = _made[token].judge
        found = [judge(t.as_py()) for t in text.cast(pa.large_binary())]
        return pa.StructArray.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
            names=["lang", "score"])

    worded = F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False))
    text = F.when(worded, letters(F.col("text"))).otherwise("")
    rows = docs.select("doc_id", judged(text).alias("__j"))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__j.lang").alias("lang_pred"),
        F.col("__j.score").alias("score"), (F.col("__j.score") >= narrow).alias("reliable"))


def predict_languages(docs: DataFrame) -> DataFrame:
    return identify(docs, dictionaries(docs))
