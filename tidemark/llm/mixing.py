"""Interleave sources so that every prefix of the result follows the target weights.

Each source's documents, in the order of a hash, form blocks of ``block_docs``. Block ``j`` of a
source that owns ``a`` of ``D`` slots is released at slot ``floor(j D / a)`` and due at slot
``ceil((j + 1) D / a)``; earliest deadline first fills the slots, and since the shares add up to
one, every block lies inside its window. So at any slot a source is less than one block away
from its share. Shares are whole numbers of slots, hence the schedule repeats every ``D`` slots
and only that many are computed, from the weights alone.

Sources without a weight of their own share that of ``REST`` equally: its blocks are dealt to them in
turn, which is the same schedule for equal shares, so each of them is less than one block away from
its part as well. Their number is counted, their names are numbered in one task.

A document's place is ``mix_slot`` (period times ``D`` plus slot) and ``mix_offset`` in the
block. When a source runs dry its slots stay empty and the others keep their relative shares;
no document is dropped or repeated. Documents are numbered inside hash buckets and the bucket
offsets are added, so no task holds a whole source; the offsets of a source, one row per bucket of
about ``BUCKET_DOCS`` documents, meet in one task. Only DataFrame functions are used.

Defined cases: null is a source like those without a weight, shown as ``REST``. Equal
ids are ordered by a hash of the text, equal rows at will. Null ids come first, dealt to buckets by their
texts. The length of a text has no influence. Empty input gives no rows; all columns are kept, but ones
named as the three results are replaced.
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import few, free_names
from tidemark.llm.scratch import written

REST = "*"
BLOCK_DOCS = 32
BUCKET_DOCS = 2_000
RESULTS = ("mix_source", "mix_slot", "mix_offset")
# Target weights of the registered query, in hundredths.
WEIGHTS = {"src0": 20, "src1": 10, "src2": 10, "src3": 5, "src4": 5, "src5": 3, "src6": 2, REST: 45}


def slots_of(weights: dict[str, int]) -> tuple[int, dict[str, list[int]]]:
    """The number of slots in a period and the slots of each source, in block order."""
    if not weights or any(w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers of at least one")
    divisor = gcd(*weights.values())
    share = {s: w // divisor for s, w in weights.items()}
    period = sum(share.values())
    placed: dict[str, list[int]] = {s: [] for s in share}
    for slot in range(period):
        ready = []
        for source, a in share.items():
            j = len(placed[source])
            if j < a and Fraction(j * period, a) < slot + 1:
                ready.append((-(-(j + 1) * period // a), source))
        placed[min(ready)[1]].append(slot)
    return period, placed


WORKING = ("lane", "turn", "its_source", "h", "text_hash", "bucket", "place", "its_lane", "its_bucket", "start")


def numbered(rows: DataFrame, of: dict[str, str], order: list[Column]) -> DataFrame:
    """``start`` plus ``place``: the place of a row inside its lane, counted bucket by bucket."""
    lane, bucket = of["lane"], of["bucket"]
    sizes = rows.groupBy(lane, bucket).agg(F.count("*").alias("rows"))
    before = Window.partitionBy(lane).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(lane).alias(of["its_lane"]), F.col(bucket).alias(of["its_bucket"]),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(of["start"]))
    inside = F.row_number().over(Window.partitionBy(lane, bucket).orderBy(*order)) - 1
    same = (F.col(lane) == F.col(of["its_lane"])) & (F.col(bucket) == F.col(of["its_bucket"]))
    return rows.withColumn(of["place"], inside).join(starts, same)


def lanes(docs: DataFrame, named: list[str]) -> DataFrame:
    """Number of each source, and its turn among those without a weight (null for the others)."""
    rest = ~F.coalesce(F.col("source").isin(named), F.lit(False))
    order = Window.orderBy(F.col("source").isNotNull(), "source")
    numbers = docs.select("source").distinct().select(
        F.col("source").alias("its_source"), F.row_number().over(order).alias("lane"),
        F.when(rest, F.sum(rest.cast("long")).over(order) - 1).alias("turn"))
    return written(numbers, "sources")


def mix_sources(docs: DataFrame, weights: dict[str, int], block_docs: int = BLOCK_DOCS) -> DataFrame:
    """All documents with ``mix_source``, ``mix_slot`` and ``mix_offset``; sort by the last two."""
    weights = {REST: 1, **weights}
    period, placed = slots_of(weights)
    buckets = max(1, docs.count() // BUCKET_DOCS)
    sources = lanes(docs, [s for s in weights if s != REST])
    sharing = sources.where("turn IS NOT NULL").count()
    kept = docs.drop(*RESULTS)
    of = dict(zip(WORKING, free_names(kept, *WORKING)))
    sources = few(sources.withColumnsRenamed({n: of[n] for n in ("lane", "turn", "its_source")}))
    rows = kept.join(sources, F.col("source").eqNullSafe(F.col(of["its_source"])))
    rows = rows.withColumns({of["h"]: F.md5(F.col("doc_id").cast("string")), of["text_hash"]: F.xxhash64("text")})
    h, text_hash, turn = (F.col(of[n]) for n in ("h", "text_hash", "turn"))
    part = F.conv(F.substring(h, 1, 6), 16, 10).cast("long")
    bucket = F.coalesce(F.floor(part * buckets / (1 << 24)), F.pmod(text_hash, F.lit(buckets)) - buckets)
    ranked = numbered(rows.withColumn(of["bucket"], bucket), of, [h, F.col("doc_id"), text_hash])
    n = F.col(of["start"]) + F.col(of["place"])
    own = F.floor(n / block_docs)
    block = F.when(turn.isNull(), own).otherwise(own * sharing + turn)
    scheduled = F.when(turn.isNull(), F.col(of["its_source"])).otherwise(REST)
    table = F.create_map(*[x for s, at in placed.items() for x in (F.lit(s), F.array(*map(F.lit, at)))])
    shares = F.create_map(*[x for s, at in placed.items() for x in (F.lit(s), F.lit(len(at)))])
    share = shares[scheduled]
    slot = F.get(table[scheduled], (block % share).cast("int"))
    return ranked.withColumns({
        "mix_source": F.coalesce(F.col(of["its_source"]), F.lit(REST)),
        "mix_slot": (F.floor(block / share) * period + slot).cast("long"),
        "mix_offset": (n % block_docs).cast("long"),
    }).drop(*of.values())


def _sql() -> str:
    period, placed = slots_of(WEIGHTS)
    values = ", ".join(f"('{s}', {k}, {at}, {len(slots)})" for s, slots in placed.items() for k, at in enumerate(slots))
    named = ", ".join(f"'{s}'" for s in WEIGHTS if s != REST)
    return f"""
WITH t(lane, k, slot, share) AS (VALUES {values}),
s AS (SELECT doc_id, text, source, CASE WHEN source IN ({named}) THEN source ELSE '{REST}' END AS lane FROM documents),
r AS (SELECT source, row_number() OVER (ORDER BY source IS NOT NULL, source) - 1 AS turn, count(*) OVER () AS sharing
  FROM (SELECT DISTINCT source FROM s WHERE lane = '{REST}')),
n AS (SELECT doc_id, source, lane, row_number() OVER (
  PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, text) - 1 AS n FROM s),
b AS (SELECT n.*, CASE WHEN lane = '{REST}' THEN n // {BLOCK_DOCS} * sharing + turn ELSE n // {BLOCK_DOCS} END AS b
  FROM n LEFT JOIN r ON n.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, coalesce(source, '{REST}') AS mix_source, CAST(b // share * {period} + slot AS BIGINT) AS mix_slot,
  CAST(n % {BLOCK_DOCS} AS BIGINT) AS mix_offset
FROM b JOIN t ON b.lane = t.lane AND b % share = k
"""


SQL = _sql()
