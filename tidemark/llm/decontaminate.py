"""Benchmark items inside documents: MinHash containment search, then an exact check.

Items are far shorter than documents, so the sketch is taken of the item alone: the smallest
hashes of its shingles, looked up among all shingles of the documents. Items are partitioned by
size; an item of ``q`` shingles in the class below ``u`` gets ``m = 2 floor((1 - t) u) + 1``
values (all, if it has fewer). A document that holds a share ``t`` of the item lacks at most
``floor((1 - t) q)`` shingles, so at least ``m - floor((1 - t) q) >= 1`` sketch values are found
in it: the search misses nothing. Pairs with that many hits are verified on the shingles
themselves. Only DataFrame functions are used; Spark broadcasts the sketch table only below
its size limit and shuffles by hash beyond it.

Words are runs of letters and digits in lower case; shingles have five words. Defined cases:
null and short texts, on either side, have no shingle and match nothing; a repeated document
row or item gives a row each; an item is its id and its text, so an id on several texts is searched for
each of them; null ids are ids like others; the shingles of a very long text are hashed as one
array, and found hashes alone are shuffled; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import without_rows
from tidemark.llm.scratch import written

WORDS = 5
CONTAINMENT = 0.8
SPLIT = "[^\\p{L}\\p{N}]+"


def words(text: Column) -> Column:
    """Words of a text; array functions see them through one binding, so the split runs once."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), lambda w: w != "")


def _runs(w: Column, make) -> Column:
    count = F.size(w) - (WORDS - 1)
    places = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: make(*[F.get(w, i + k) for k in range(WORDS)]))


def _bound(value: Column, make) -> Column:
    return F.get(F.transform(F.array(value), make), F.lit(0))


def hashes(text: Column) -> Column:
    return _bound(words(text), lambda w: _runs(w, F.xxhash64))


def shingles(text: Column) -> Column:
    return F.array_distinct(_bound(words(text), lambda w: _runs(w, lambda *x: F.concat_ws(" ", *x))))


def sketch(items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """item_id, item_key, need, hash: the smallest hashes of each item and how many must be found."""
    sized = items.select("item_id", F.xxhash64("text").alias("item_key"), F.array_sort(F.array_distinct(hashes(F.col("text")))).alias("h")).withColumn(
        "q", F.size("h")).where("q > 0")
    slack = F.lit(1 - containment + 1e-9)
    above = F.pow(F.lit(2), F.floor(F.log2("q")) + 1)
    m = F.least(F.col("q"), (2 * F.floor(slack * above) + 1).cast("int"))
    need = m - F.floor(slack * F.col("q")).cast("int")
    return sized.select("item_id", "item_key", need.alias("need"), F.explode(F.slice("h", F.lit(1), m)).alias("hash"))


def contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, shared, total, containment, text_key of every pair that reaches the share."""
    small = written(sketch(items, containment), "sketch")
    found = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.explode(hashes(F.col("text"))).alias("hash"))
    hits = found.join(small, "hash").groupBy("doc_id", "text_key", "item_id", "item_key").agg(
        F.count_distinct("hash").alias("hits"), F.max("need").alias("need"))
    pairs = written(hits.where("hits >= need").select(
        F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), F.col("item_id").alias("__item"),
        F.col("item_key").alias("__item_key")), "pairs")
    whole = items.select("item_id", F.xxhash64("text").alias("item_key"), shingles(F.col("text")).alias("__wanted"))
    text = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    checked = (
        text.join(pairs, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_key") == F.col("__key")))
        .join(whole, F.col("__item").eqNullSafe(F.col("item_id")) & (F.col("__item_key") == F.col("item_key")))
        .withColumn("shared", F.size(F.array_intersect(shingles(F.col("text")), "__wanted")).cast("long"))
        .withColumn("total", F.size("__wanted").cast("long"))
    )
    return checked.where(F.col("shared") >= F.col("total") * containment - 1e-9).select(
        "doc_id", "item_id", "shared", "total", F.round(F.col("shared") / F.col("total"), 6).alias("containment"), "text_key")


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    bad = contaminated(docs, items).select("doc_id", F.col("text_key").alias("mark")).distinct()
    return without_rows(docs, F.xxhash64("text"), written(bad, "contaminated"))


SQL = f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
  FROM documents),
v AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w
  FROM benchmark),
d AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - {WORDS - 2}),
  lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS s FROM w WHERE len(w) >= {WORDS}),
b AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - {WORDS - 2}),
  lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS s FROM v WHERE len(w) >= {WORDS}),
n AS (SELECT item_id, count(*) AS total FROM b GROUP BY item_id),
j AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, shared, total, round(shared / total, 6) AS containment
FROM j JOIN n USING (item_id) WHERE shared >= total * {CONTAINMENT} - 1e-9
"""
