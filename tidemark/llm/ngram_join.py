"""Documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Copies (equal sets) become one class first; all further work is on classes, which have numbers of
their own, so ids may repeat or be null. Every class has a MinHash signature of ``BANDS`` by ``ROWS``
values, and only classes that agree in a whole band, that is, share a bucket, are compared.

To meet each pair once and never emit pairs, a class has a home, the largest bucket it is in.
Classes of one home form a cell and are compared there; two cells meet in a piece of work of their
own, to which the classes go that share a bucket with the other cell, or all of the cell where that
is less. A cell above ``CHUNK``
classes is cut, and pairs of its parts are separate pieces, so every piece is bounded and a chain of
neighbours costs what its buckets hold, not the square of its length. Inside a piece, pairs
that share a bucket are pruned by a Bayesian test: the signatures are compared a few values at a
time, and a pair is dropped once the posterior probability (uniform prior) that its similarity
reaches the threshold falls below ``TOLERANCE``. The rest is verified exactly on the shingle sets. No
pair leaves its task: a piece gives, per class, the number of its links and the least class it
is connected to, and one run of connected components joins these.

At a similarity of exactly 0.8 a pair misses all bands with probability 1.3e-7 and is dropped by the
test with at most ``TOLERANCE``. Each further similar pair has the same odds, whatever the size.

Results per document: ``class_id``, the least doc_id of its component, and ``n_links``, how many
other documents, copies included, are similar to it. Defined cases: fewer than five words make
one shingle; documents without words (null, empty) are copies of each other; rows that repeat an id
count each, by their own texts; null ids are rows like others, and a component of null ids only
has a null class_id; a long text gives one row that is as long as its shingles; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.rows import few, without_rows
from tidemark.llm.scratch import written
from tidemark.llm.text_hash import U, gram_sets, mix, word_slices

WORDS = 5
SIMILAR = 0.8
ROWS, BANDS = 5, 40
TOLERANCE = 1e-6
STEP = 25
CHUNK = 1024
_rng = np.random.default_rng(8675309)
_TIMES = (_rng.integers(0, 2**31, size=ROWS * BANDS) * 2 + 1).astype(np.uint32)
_PLUS = _rng.integers(0, 2**32, size=ROWS * BANDS, dtype=np.uint32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=U))


def signature(grams: np.ndarray) -> np.ndarray:
    """MinHash values of one non-empty set of 64-bit hashes."""
    low = (grams >> U(32)).astype(np.uint32)
    out = np.full(len(_TIMES), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 2048):
        part = np.multiply.outer(_TIMES, low[at : at + 2048]) + _PLUS[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    key = _BAND.copy()
    for column in values.reshape(BANDS, ROWS).T.astype(U):
        key = mix(key + column)
    return key.view(np.int64)


def _binary(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([s.tobytes() for s in sets], pa.large_binary()).cast(pa.binary())


def _described(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, second, keys = [], [], []
        for words in word_slices(batch.column(0)):
            for grams in gram_sets(words, WORDS):
                first.append(int(grams.sum(dtype=U).view(np.int64)))
                second.append(int(mix(grams).sum(dtype=U).view(np.int64)))
                keys.append(band_keys(signature(grams)) if len(grams) else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(first, pa.int64()), pa.array(second, pa.int64()),
             pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "text_hash", "h1", "h2", "keys"])


def _with_sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class and shingle set of each text; a class that comes again in a task is left out."""
    seen: set[int] = set()
    for batch in batches:
        nodes = batch.column(1).to_pylist()
        fresh = [k for k, n in enumerate(nodes) if n not in seen and n not in nodes[:k]]
        seen.update(nodes)
        batch = batch.take(pa.array(fresh, pa.int64()))
        sets = [s for words in word_slices(batch.column(0)) for s in gram_sets(words, WORDS)]
        # Rows are given in small batches, because a set may be larger than its text.
        for at in range(0, len(sets), 256):
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, 256), _binary(sets[at : at + 256])], ["node", "grams"])


@cache
def least_matches(n: int, similar: float, tolerance: float) -> int:
    """The fewest agreeing values of ``n`` for which the posterior is not below the tolerance.

    With a uniform prior, P(J >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    below = 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * similar**m * (1 - similar) ** (n + 1 - m)
        if below >= tolerance:
            return m
    return n


class Piece:
    """The classes of a cell or of two sides, and the links found between them."""

    def __init__(self, similar: float = SIMILAR, tolerance: float = TOLERANCE):
        self.similar, self.tolerance = similar, tolerance
        self.ids: list[int] = []
        self.weights: list[int] = []
        self.sides: list[int] = []
        self.sets: list[np.ndarray] = []
        self.seen: set[int] = set()

    def add(self, node: int, weight: int, side: int, grams: bytes) -> None:
        """Take a class once; a repeated row of its document comes again."""
        if node in self.seen:
            return
        self.seen.add(node)
        self.ids.append(node)
        self.weights.append(weight)
        self.sides.append(side)
        self.sets.append(np.frombuffer(grams, dtype=U))

    def _survivors(self, i: int, others: np.ndarray, signs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        near = (sizes[others] >= self.similar * sizes[i]) & (sizes[others] * self.similar <= sizes[i])
        others = others[near]
        agree = np.zeros(len(others), dtype=np.int64)
        for begin in range(0, signs.shape[1], STEP):
            if len(others) == 0:
                break
            span = slice(begin, begin + STEP)
            agree = agree + (signs[others, span] == signs[i, span]).sum(axis=1)
            stays = agree >= least_matches(begin + STEP, self.similar, self.tolerance)
            others, agree = others[stays], agree[stays]
        return others

    def _linked(self, i: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if len(others) == 0:
            return others
        mine = self.sets[i]
        found = []
        for at in range(0, len(others), 64):
            theirs = np.concatenate([self.sets[j] for j in others[at : at + 64]])
            place = np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)
            starts = np.concatenate([[0], np.cumsum(sizes[others[at : at + 64]])[:-1]])
            found.append(np.add.reduceat((mine[place] == theirs).astype(np.int64), starts))
        shared = np.concatenate(found)
        return others[shared >= self.similar * (sizes[i] + sizes[others] - shared) - 1e-9]

    def links(self) -> tuple[list[int], list[int], list[int]]:
        """Ids, linked documents of each, and the least id each is connected to."""
        n = len(self.ids)
        signs = np.stack([signature(s) for s in self.sets])
        keys = np.stack([band_keys(s) for s in signs])
        sizes = np.array([len(s) for s in self.sets])
        sides, weights = np.array(self.sides), np.array(self.weights)
        cross = len(set(self.sides)) > 1
        counts = np.zeros(n, dtype=np.int64)
        root = list(range(n))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i in range(n):
            others = np.arange(i + 1, n)
            if cross:
                others = others[sides[others] != sides[i]]
            others = others[(keys[others] == keys[i]).any(axis=1)]
            for j in (found := self._linked(i, self._survivors(i, others, signs, sizes), sizes)):
                a, b = top(i), top(int(j))
                if a != b:
                    low, high = (a, b) if self.ids[a] <= self.ids[b] else (b, a)
                    root[high] = low
            counts[i] += weights[found].sum()
            counts[found] += weights[i]
        return self.ids, counts.tolist(), [self.ids[top(i)] for i in range(n)]


PIECE = ["first", "second", "low", "high"]


def _pieces(similar: float, tolerance: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by piece; only one is held at a time."""

        def out() -> Iterator[pa.RecordBatch]:
            if at is not None and (at[0] == at[1] and at[2] == at[3] or len(set(piece.sides)) > 1):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in piece.links()], ["node", "links", "root"])

        at, piece = None, Piece(similar, tolerance)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*PIECE, "node", "weight", "side")]
            grams = batch.column("grams")
            for k, (*place, node, weight, side) in enumerate(zip(*columns)):
                if place != at:
                    yield from out()
                    at, piece = place, Piece(similar, tolerance)
                piece.add(node, weight, side, grams[k].as_py())
        yield from out()

    return run


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text, a 128-bit hash of its shingle set in two halves, and band keys; written once."""
    rows = docs.select("text", F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"))
    return written(rows.mapInArrow(_described, "doc_id long, text_hash long, h1 long, h2 long, keys array<long>"), "signatures")


def classes_of(described: DataFrame) -> DataFrame:
    """Number, copies, band keys and the leading row of each class: its least id, null ids last."""
    lead = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    grouped = described.groupBy("h1", "h2").agg(F.min(lead).alias("lead"), F.count("*").alias("copies"), F.first("keys").alias("keys"))
    return written(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")


def meetings(classes: DataFrame, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """Classes that share a bucket, with their homes, and the pieces of work each goes to."""
    keyed = classes.select("node", F.explode("keys").alias("key"))
    shared = written(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    inside = written(keyed.join(shared, "key"), "shared-buckets")
    homes = written(inside.groupBy("node").agg(F.max_by("key", F.struct("n", "key")).alias("home")), "homes")
    placed = inside.select("key", "node").join(homes, "node")
    cells = written(placed.groupBy("key", "home").agg(F.count("*").alias("rows")), "cells")
    facing = cells.select("key", F.col("home").alias("other"))
    meets = written(cells.join(facing, "key").where("home <> other"), "meeting-cells")
    sizes = homes.groupBy("home").agg(F.count("*").alias("size"))
    pairs = meets.groupBy("home", "other").agg(F.sum("rows").alias("touching")).join(sizes, "home")
    pairs = written(pairs.select("home", "other", (F.col("touching") >= F.col("size")).alias("whole")), "cell-pairs")
    # A cell that meets another in so many buckets goes there whole, else only the classes that do.
    all_go = homes.join(pairs.where("whole").select("home", "other"), "home")
    some = meets.join(pairs.where("NOT whole").select("home", "other"), ["home", "other"]).select("key", "home", "other")
    some_go = placed.join(some, ["key", "home"]).select("node", "home", "other").distinct()
    across = all_go.select("node", "home", "other").unionByName(some_go)
    parts = homes.groupBy("home").agg(F.ceil(F.count("*") / chunk).cast("int").alias("parts"))
    both = homes.select("node", "home", F.col("home").alias("other")).unionByName(across)
    both = both.join(parts, "home").join(parts.select(F.col("home").alias("other"), F.col("parts").alias("their")), "other")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    dealt = both.withColumn("part", part).withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("their") - 1)))
    alone, before = F.col("home") == F.col("other"), F.col("home") < F.col("other")
    dealt = dealt.select(
        "node", F.least("home", "other").alias("first"), F.greatest("home", "other").alias("second"),
        F.when(alone, F.least("part", "facing")).when(before, F.col("part")).otherwise(F.col("facing")).alias("low"),
        F.when(alone, F.greatest("part", "facing")).when(before, F.col("facing")).otherwise(F.col("part")).alias("high"),
        F.when(alone, F.col("part")).otherwise(before.cast("int")).alias("side"))
    return homes, dealt


def linked(docs: DataFrame, classes: DataFrame, similar: float, tolerance: float, chunk: int) -> DataFrame:
    """(node, links, root) of every piece of work."""
    homes, dealt = meetings(classes, chunk)
    member = written(classes.join(homes, "node").select(
        "node", F.col("copies").alias("weight"), F.col("lead.doc_id").alias("lead_id"), F.col("lead.text_hash").alias("lead_hash")), "members")
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), "text")
    chosen = text.join(few(member), F.col("id").eqNullSafe(F.col("lead_id")) & (F.col("hash") == F.col("lead_hash")))
    sets = written(chosen.select("text", "node").mapInArrow(_with_sets, "node long, grams binary"), "shingle-sets")
    rows = dealt.join(member.select("node", "weight"), "node").join(sets, "node")
    ordered = rows.repartition(*PIECE).sortWithinPartitions(*PIECE)
    return written(ordered.mapInArrow(_pieces(similar, tolerance), "node long, links long, root long"), "links")


def classified(
    docs: DataFrame, similar: float = SIMILAR, tolerance: float = TOLERANCE, chunk: int = CHUNK
) -> DataFrame:
    """doc_id and text_hash of every row with its class_id, n_links, and whether its text and id lead."""
    described = describe(docs)
    classes = classes_of(described)
    found = linked(docs, classes, similar, tolerance, chunk)
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = counts.join(roots, "node", "left").select("node", "links", F.coalesce("root", "node").alias("root"))
    joined = joined.join(classes.select("node", "lead"), "node")
    leads = joined.groupBy("root").agg(F.min("lead").alias("first"))
    near = joined.join(leads, "root").select("node", "links", "first")
    known = classes.select("h1", "h2", "node", "copies", "lead").join(near, "node", "left").select(
        "h1", "h2", F.coalesce("first", "lead").alias("first"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"))
    leads = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    return described.select("doc_id", "text_hash", "h1", "h2").join(known, ["h1", "h2"]).select(
        "doc_id", "text_hash", F.col("first.doc_id").alias("class_id"), "n_links", leads.alias("leads"))


def similar_documents(
    docs: DataFrame, similar: float = SIMILAR, tolerance: float = TOLERANCE, chunk: int = CHUNK
) -> DataFrame:
    """doc_id, class_id, n_links of every document."""
    return classified(docs, similar, tolerance, chunk).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of similar ones, with all its columns: the least id stays.

    Rows are told apart by id and text, so other texts under the same id stay. Of rows that repeat
    both, one stays; they are put together apart from the others, which are not shuffled.
    """
    rows = written(classified(docs).select("doc_id", F.col("text_hash").alias("mark"), "leads"), "similar")
    gone = written(rows.where("NOT leads").select("doc_id", "mark").distinct(), "gone")
    again = rows.where("leads").groupBy("doc_id", "mark").agg(F.count("*").alias("rows")).where("rows > 1")
    return without_rows(docs, F.xxhash64("text"), gone, written(again.select("doc_id", "mark"), "repeated"))


_SHINGLES = f"""
w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [''] WHEN len(w) < {WORDS} THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - {WORDS - 2}), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' ')) END) AS s FROM w)"""
SQL = f"""
WITH RECURSIVE {_SHINGLES},
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE c >= {SIMILAR} * (x.n + y.n - c) - 1e-9),
r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.other = l.a)
SELECT doc_id, min(other) AS class_id, (SELECT count(*) FROM l WHERE a = r.doc_id) AS n_links FROM r GROUP BY doc_id
"""
