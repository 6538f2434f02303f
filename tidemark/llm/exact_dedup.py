"""Exact duplicates through a sharded cuckoo-filter index of text digests.

Digests are dealt to shards by their first bits. A shard holds a cuckoo filter (four 16-bit
fingerprints a bucket) and, per home bucket, the stored keys with their live counts. A digest
that misses the filter is new; a hit is verified against the keys stored in its bucket, so a
false positive never merges two texts. Deleting the last live copy removes the fingerprint.
When an insertion finds no room the filter doubles and is filled again from the stored keys.

Defined cases: a null text counts as empty; texts are equal when identical after every run of
white space became one space; the smallest doc_id of equal texts stays, a null id counts as the
largest. Of repeated rows of one id and text exactly one stays. Empty input gives no rows, and
columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import without_rows
from tidemark.llm.scratch import durable, written

WHITE = "[\\x20\\x09-\\x0D]+"
SHARD_KEYS = 200_000
SLOTS = 4
MAX_KICKS = 200
_NO_ID = np.iinfo(np.int64).max
KEYS = "shard long, digest string, keep_id long, live long"


class CuckooFilter:
    """Approximate membership of 64-bit hashes with deletion."""

    def __init__(self, buckets: int = 64):
        self.mask = buckets - 1
        self.slots = [[] for _ in range(buckets)]

    def _places(self, h: int) -> tuple[int, int, int]:
        mark = (h >> 48) or 1
        home = h & self.mask
        return mark, home, home ^ (mark * 0x5BD1E995 & self.mask)

    def __contains__(self, h: int) -> bool:
        mark, a, b = self._places(h)
        return mark in self.slots[a] or mark in self.slots[b]

    def insert(self, h: int) -> bool:
        """False if no room was found; the filter must then be built anew with more buckets."""
        mark, a, b = self._places(h)
        for at in (a, b):
            if len(self.slots[at]) < SLOTS:
                self.slots[at].append(mark)
                return True
        at = b
        for kick in range(MAX_KICKS):
            mark, self.slots[at][kick % SLOTS] = self.slots[at][kick % SLOTS], mark
            at ^= mark * 0x5BD1E995 & self.mask
            if len(self.slots[at]) < SLOTS:
                self.slots[at].append(mark)
                return True
        return False

    def delete(self, h: int) -> None:
        mark, a, b = self._places(h)
        for at in (a, b):
            if mark in self.slots[at]:
                self.slots[at].remove(mark)
                return


class Shard:
    """Live digests of one shard: the filter, and stored keys in buckets of their own hash."""

    def __init__(self, buckets: int = 64):
        self.filter = CuckooFilter(buckets)
        self.stored: dict[int, list[list]] = {}
        self.resizes = 0

    @staticmethod
    def _hash(digest: str) -> int:
        return int(digest[16:32], 16)

    def _verified(self, h: int, digest: str) -> list | None:
        if h not in self.filter:
            return None
        return next((k for k in self.stored.get(h, ()) if k[0] == digest), None)

    def insert(self, digest: str, keep_id: int, live: int) -> None:
        h = self._hash(digest)
        key = self._verified(h, digest)
        if key:
            key[1], key[2] = min(key[1], keep_id), key[2] + live
            return
        self.stored.setdefault(h, []).append([digest, keep_id, live])
        if not self.filter.insert(h):
            self._resize()

    def delete(self, digest: str, live: int) -> None:
        h = self._hash(digest)
        key = self._verified(h, digest)
        if key is None:
            return
        key[2] -= live
        if key[2] <= 0:
            self.stored[h].remove(key)
            if not self.stored[h]:
                del self.stored[h]
            self.filter.delete(h)

    def _resize(self) -> None:
        buckets = (self.filter.mask + 1) * 2
        while True:
            fresh = CuckooFilter(buckets)
            if all(fresh.insert(h) for h, keys in self.stored.items() for _ in keys):
                self.filter = fresh
                self.resizes += 1
                return
            buckets *= 2

    def keys(self) -> Iterator[tuple]:
        for keys in self.stored.values():
            yield from (tuple(k) for k in keys)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("digest"))


def _with_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID).cast("long")))


def _combine(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per digest of an Arrow batch, so that a hot text sends one row a batch.

    Ids must not be null: a batch with a null would come as floats, which round large ids.
    """
    for batch in batches:
        grouped = batch.groupby("digest", sort=False)
        yield grouped.agg(keep_id=("doc_id", "min"), live=("doc_id", "size")).reset_index()


def _apply(shards: dict[int, Shard], shard: int, digest: str, keep_id: int, live: int) -> None:
    held = shards.setdefault(shard, Shard())
    if live >= 0:
        held.insert(digest, keep_id, live)
    else:
        held.delete(digest, -live)


def _fill(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Insert and delete rows that come sorted by shard; give the stored keys of each shard."""
    shards: dict[int, Shard] = {}

    def out() -> pd.DataFrame:
        rows = [(number, *key) for number, held in shards.items() for key in held.keys()]
        return pd.DataFrame(rows, columns=["shard", "digest", "keep_id", "live"])

    for batch in batches:
        for row in zip(batch["shard"], batch["digest"], batch["keep_id"], batch["live"]):
            if row[0] not in shards:
                yield out()
                shards.clear()
            _apply(shards, *row)
    yield out()


def _shards(rows: int) -> int:
    return 1 << max(4, (rows // SHARD_KEYS).bit_length())


def _shard_of(shards: int) -> Column:
    return F.conv(F.substring("digest", 1, 12), 16, 10).cast("long") % F.lit(shards)


def build_index(rows: DataFrame, count: int) -> DataFrame:
    """Stored keys (shard, digest, keep_id, live) of ``count`` digest rows."""
    shards = _shards(count)
    partial = _with_ids(rows).mapInPandas(_combine, "digest string, keep_id long, live long")
    return _filled(partial.withColumn("shard", _shard_of(shards)), shards)


def update_index(
    index: DataFrame, shards: int, inserted: DataFrame, deleted: DataFrame, live: DataFrame | None = None
) -> DataFrame:
    """The index after insertions and deletions of digest rows.

    Stored keys enter first, so a shard's filter is filled from them. ``live`` are the digest rows
    of all documents that are left; it names the next row to stay where the one that stayed goes.
    """
    spec = "digest string, keep_id long, live long"
    plus = _with_ids(inserted).mapInPandas(_combine, spec)
    minus = _with_ids(deleted).mapInPandas(_combine, spec).withColumn("live", -F.col("live"))
    moved = plus.unionByName(minus).withColumn("shard", _shard_of(shards))
    after = _filled(index.unionByName(moved), shards)
    if live is None:
        return after
    after = durable(after)
    gone = deleted.select("digest", F.coalesce("doc_id", F.lit(_NO_ID)).alias("keep_id"))
    lost = after.join(gone, ["digest", "keep_id"], "left_semi").select("digest")
    next_id = live.join(lost, "digest", "left_semi").groupBy("digest").agg(F.min("doc_id").alias("next_id"))
    return after.join(next_id, "digest", "left").select(
        "shard", "digest", F.coalesce("next_id", "keep_id").alias("keep_id"), "live")


def _filled(rows: DataFrame, shards: int) -> DataFrame:
    ordered = rows.repartition(shards, "shard").sortWithinPartitions("shard", F.col("live") < 0)
    return ordered.select("shard", "digest", "keep_id", "live").mapInPandas(_fill, KEYS)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept for every row."""
    rows = durable(digests(docs))
    keys = build_index(rows, rows.count()).select(
        "digest", F.nullif("keep_id", F.lit(_NO_ID)).alias("keep_id"), F.col("live").alias("group_size")
    )
    single = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("repeats"))
    return (
        single.join(keys, "digest")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1))
        .select("doc_id", "digest", "keep_id", "group_size", "kept")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    The rows that go are named by id and digest; no text is shuffled while these are few.
    """
    rows = written(exact_duplicates(docs).select("doc_id", F.col("digest").alias("mark"), "keep_id", "kept"), "duplicates")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = written(rows.where(~stays).select("doc_id", "mark").distinct(), "gone")
    again = written(rows.where(stays & ~F.col("kept")).select("doc_id", "mark").distinct(), "repeated")
    return without_rows(docs, F.sha2(normalised(F.col("text")), 256), gone, again)


SQL = """
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS h
  FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, n.h AS text_sha256
FROM n JOIN g ON n.h = g.h
"""
