"""Align the tokens of two tokenizers and score token pairs by an inverted index of bitmaps.

Both tokenizers cut the same bytes (a space and the text). Byte offsets at which both end a token
cut a document into groups, and two tokens are linked where their byte ranges overlap. Between
two neighbouring ends, of either tokenizer, lies exactly one pair of overlapping tokens, so the
links of a document are the distinct ends, each with the token of either side that covers it.

The index holds, per pair of ids, compressed bitmaps over the documents: plane 0 marks those that
hold the pair, and plane k those whose number of further links has bit k - 1 set. A task numbers
its documents in blocks of at most ``BLOCK_DOCS``; a bitmap covers one block, as a sorted list of
slots or as bits, whichever is smaller. The bitmaps of the slices of a block are OR-merged there;
those of different blocks are disjoint, so the popcounts of their union add up: plane 0 gives a
pair's documents, and all planes together, weighted by their bits, its links. The scores go back along
the postings: bitmaps with their pair's score are dealt by block, and a task adds up the scores
of the documents of one block at a time. No text and no link is shuffled, only bitmaps.

Texts are cut at the spaces that follow a sign which is no white space. Neither tokenizer has a token
across such a place, so a text's tokens are those of its pieces, each with the space before it, and
groups and links stay inside a piece. Every different piece is tokenized and aligned once and
held, up to ``CACHED`` pieces and ``LINKS`` links; a text adds up its pieces. A text with a piece that
is not kept byte by byte, and every text of a vocabulary for which the above may fail, is one piece.

A block ends after ``BLOCK_POSTINGS`` postings at the latest, which bounds what a task holds beside the
links of one document. A pair that stands in every document has one row per block, so no pair is hot.

Defined cases: a text that is null, empty, or not kept byte by byte by one of the tokenizers has no
tokens: zeros and an empty group text; rows that repeat an id are documents of their own, null
ids too; extra columns are ignored; an empty table gives no rows. Equal scores tie: each pair with
the highest count of its second id is a best one.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain, count, repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tidemark.llm.bpe_codec import text_slices
from tidemark.llm.byte_bpe import ByteBpe, joiner
from tidemark.llm.scratch import written

BLOCK_DOCS = 1 << 16
BLOCK_POSTINGS = 1 << 22
SLICE = 1 << 20
ROWS_OUT = 1 << 14
CACHED = 1 << 18
LINKS = 1 << 21
LONG = 64  # characters; longer pieces are not held
JOINED = 256  # pieces
LOW = 26  # bits; sums are kept in two halves that doubles hold exactly

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
INDEX = pa.schema([
    ("block", pa.int64()), ("plane", pa.int32()), ("slot", pa.int32()), ("doc_id", pa.int64()),
    *[(c, pa.int64()) for c in COUNTS], ("groups_sha256", pa.string()),
    ("pair", pa.int64()), ("n", pa.int64()), ("bits", pa.binary())])
DOCUMENT = -1  # the plane of rows that describe a document


@dataclass
class Aligned:
    """The tokens of some texts as flat arrays; ends are byte offsets in all texts joined."""

    rows: np.ndarray  # of the column, those that have tokens
    a: np.ndarray
    b: np.ndarray
    end_a: np.ndarray
    end_b: np.ndarray
    text_end: np.ndarray

    def __post_init__(self):
        # Marks at byte offsets and counts before them take the place of searches in sorted ends.
        mark = np.zeros(int(self.text_end[-1]) + 1 if len(self.text_end) else 1, dtype=np.int8)
        mark[self.end_a] = 1
        mark[self.end_b] += 2
        self.ends, self.cuts = np.flatnonzero(mark), np.flatnonzero(mark == 3)
        self._mark = mark

    def _before(self, marked: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How many of the marked offsets lie before each end."""
        return (np.cumsum(marked, dtype=np.int32) - marked)[ends]

    def per_text(self, ends: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(ends, self.text_end, side="right"), prepend=0)

    def groups_of(self, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The group of each end, and whether it is the last one there."""
        return self._before((self._mark == 3).astype(np.int8), ends), self._mark[ends] == 3

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """First and second id of every link."""
        return self.a[self._before(self._mark & 1, self.ends)], self.b[self._before(self._mark >> 1, self.ends)]


@dataclass
class Linked:
    """The counts of each text, its groups as a text, and all links."""

    counts: np.ndarray
    groups: list[str]
    text: np.ndarray
    pair: np.ndarray


class Pieces:
    """The alignments of different pieces, by number."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((0, len(COUNTS)), dtype=np.int64)
        self.pairs = np.zeros(0, dtype=np.int64)

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, -1 for one that is not held."""
        return np.fromiter(map(self.number.get, pieces, repeat(-1)), np.int64, len(pieces))

    def add(self, pieces: list[str], counts: np.ndarray, groups: list[str], pairs: np.ndarray) -> None:
        self.number.update(zip(pieces, range(len(self.groups), len(self.groups) + len(pieces))))
        self.groups += groups
        self.counts = np.concatenate([self.counts, counts])
        self.pairs = np.concatenate([self.pairs, pairs])

    def keep(self, size: int) -> None:
        """Forget the pieces from a number on."""
        for _ in range(len(self.number) - size):
            self.number.popitem()
        self.pairs = self.pairs[: int(self.counts[:size, -1].sum())]
        self.counts = self.counts[:size]
        del self.groups[size:]


class Aligner:
    """Both tokenizers, their token bytes, and the texts of their ids."""

    def __init__(self, first: bytes, second: bytes):
        self.first = ByteBpe(first, special=False)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=second)
        pieces = [self._bytes(i) for i in range(len(self.second))]
        self.length = np.array([len(p) for p in pieces], dtype=np.int64)
        self.joined = joiner(pieces)
        self.size_a, self.size_b = len(self.first.tokens), len(pieces)
        self.names_a = self._names(self.size_a, ",|")
        self.names_b = self._names(self.size_b, ",;")
        self.apart = self._apart(second)
        # The literal space comes first, which the search needs to be fast.
        self._cut = re.compile(r" (?<=\S )(?!\Z)").split if self.apart else lambda text: [text]
        self._held = Pieces()

    def _apart(self, second: bytes) -> bool:
        """Whether no token of the second vocabulary reaches across the space after another sign."""
        spec = sentencepiece_model_pb2.ModelProto.FromString(second)
        trainer, normal = spec.trainer_spec, spec.normalizer_spec
        return (
            trainer.model_type == trainer.BPE and trainer.byte_fallback and not trainer.treat_whitespace_as_suffix
            and normal.add_dummy_prefix and normal.escape_whitespaces and not normal.remove_extra_whitespaces
            and not normal.precompiled_charsmap and not any(re.search("[^▁]▁", p.piece) for p in spec.pieces))

    def _bytes(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.second.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def _names(size: int, marks: str) -> np.ndarray:
        return np.array([f"{i}{mark}" for mark in marks for i in range(size)], dtype=object)

    @staticmethod
    def _kept(ids: np.ndarray, counts: np.ndarray, joined, wanted: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which texts the tokens of a tokenizer spell byte by byte."""
        data, end = joined(ids)
        end = np.append(0, end)[np.cumsum(counts)]
        spelled = np.diff(end, prepend=0)
        good = spelled == lengths
        data, wanted = data[np.repeat(good, spelled)], wanted[np.repeat(good, lengths)]
        other = np.searchsorted(np.cumsum(lengths[good]), np.flatnonzero(data != wanted), side="right")
        good[np.flatnonzero(good)[other]] = False
        return good

    def align(self, texts: list[str]) -> Aligned:
        """The texts that both tokenizers keep byte by byte."""
        spaced = [" " + t for t in texts]
        encoded = [t.encode() for t in spaced]
        lengths = np.array([len(x) for x in encoded], dtype=np.int64)
        wanted = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        ids_a, ids_b = self.first.encode(spaced), self.second.encode(texts, num_threads=1)
        counts_a = np.array([len(x) // 4 for x in ids_a], dtype=np.int64)
        counts_b = np.array([len(x) for x in ids_b], dtype=np.int64)
        a = np.frombuffer(b"".join(ids_a), dtype=np.int32).astype(np.int64)
        b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(counts_b.sum()))
        good = np.array([t != "" for t in texts], dtype=bool)
        good &= self._kept(a, counts_a, self.first.joined, wanted, lengths) & self._kept(b, counts_b, self.joined, wanted, lengths)
        a, b = a[np.repeat(good, counts_a)], b[np.repeat(good, counts_b)]
        return Aligned(
            np.flatnonzero(good), a, b, np.cumsum(self.first.lengths[a]), np.cumsum(self.length[b]), np.cumsum(lengths[good]))

    def _hold(self, pieces: list[str], found: Aligned) -> None:
        counts, groups = np.zeros((len(pieces), len(COUNTS)), dtype=np.int64), [""] * len(pieces)
        if len(found.rows):
            counts[found.rows] = np.stack([found.per_text(e) for e in (found.end_a, found.end_b, found.cuts, found.ends)], axis=1)
            for k, text in zip(found.rows.tolist(), self.groups(found)):
                groups[k] = text
        a, b = found.links()
        self._held.add(pieces, counts, groups, a * self.size_b + b)

    def _learn(self, pieces: list[str]) -> None:
        """Align and hold new pieces, many in a text; alone go those that no text continues, and changed ones."""
        closed, alone = [], []
        for p in pieces:
            (closed if self.apart and p and not p[-1].isspace() and "▁" not in p else alone).append(p)
        some = [closed[k : k + JOINED] for k in range(0, len(closed), JOINED)]
        found = self.align([" ".join(s) for s in some])
        kept = found.rows.tolist()
        done = list(chain.from_iterable(some[k] for k in kept))
        found.rows = np.arange(len(done))
        found.text_end = np.cumsum(np.fromiter(map(len, map(str.encode, done)), np.int64, len(done)) + 1)
        self._hold(done, found)
        alone += chain.from_iterable(some[k] for k in set(range(len(some))).difference(kept))
        self._hold(alone, self.align(alone))

    def _numbers(self, pieces: list[list[str]]) -> tuple[np.ndarray, int]:
        """The numbers of all pieces, and how many are held before the first long one that is new."""
        first: dict[str, int] = {}
        at = np.fromiter(map(first.setdefault, chain.from_iterable(pieces), count()), np.int64)
        number = self._held.numbers(list(first))
        new = [piece for piece, k in zip(first, number.tolist()) if k < 0]
        self._learn([p for p in new if len(p) <= LONG])
        stay = len(self._held.groups)
        long = [p for p in new if len(p) > LONG]
        self._hold(long, self.align(long))
        number[number < 0] = self._held.numbers(new)
        everywhere = np.zeros(len(at), dtype=np.int64)
        everywhere[list(first.values())] = number
        return everywhere[at], stay

    def linked(self, texts: list[str]) -> Linked:
        """All texts, in order; those that a tokenizer does not keep byte by byte have no tokens."""
        if len(self._held.groups) > CACHED or len(self._held.pairs) > LINKS:
            self._held = Pieces()
        held, pieces = self._held, [self._cut(t) for t in texts]
        number, stay = self._numbers(pieces)
        sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        changed = np.unique(np.repeat(np.arange(len(texts)), sizes)[held.counts[number, 0] == 0]).tolist()
        if any(sizes[k] > 1 for k in changed):
            for k in changed:
                pieces[k] = [texts[k]]
            number, _ = self._numbers(pieces)
            sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        text, counts = np.repeat(np.arange(len(texts)), sizes), held.counts[number]
        links = counts[:, -1]
        begin = np.cumsum(held.counts[:, -1])[number] - links
        place = np.repeat(begin - (np.cumsum(links) - links), links) + np.arange(int(links.sum()))
        stop, each = np.cumsum(sizes).tolist(), list(map(held.groups.__getitem__, number.tolist()))
        total = np.add.reduceat(counts, np.cumsum(sizes) - sizes) if len(texts) else counts
        out = Linked(total, [";".join(each[i:j]) for i, j in zip([0, *stop], stop)], np.repeat(text, links), held.pairs[place])
        held.keep(stay)
        return out

    def groups(self, found: Aligned) -> list[str]:
        """The ids of each text, group by group: those of the first, ``|``, those of the second, ``;``."""
        if len(found.rows) == 0:
            return []
        group_a, last_a = found.groups_of(found.end_a)
        group_b, last_b = found.groups_of(found.end_b)
        names = np.concatenate([self.names_a[found.a + self.size_a * last_a], self.names_b[found.b + self.size_b * last_b]])
        names = names[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")].tolist()
        stop = np.cumsum(found.per_text(found.end_a) + found.per_text(found.end_b)).tolist()
        return ["".join(names[i:j])[:-1] for i, j in zip([0, *stop], stop)]


_made: dict[str, Aligner] = {}


class Shared:
    """Both vocabulary files for the workers of a session."""

    def __init__(self, docs: DataFrame, first: str, second: str):
        self.token = uuid.uuid4().hex
        self._content = docs.sparkSession.sparkContext.broadcast((Path(first).read_bytes(), Path(second).read_bytes()))

    def aligner(self) -> Aligner:
        if self.token not in _made:
            _made.clear()
            _made[self.token] = Aligner(*self._content.value)
        return _made[self.token]


def groups(docs: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id and the text of its groups, empty without tokens."""
    shared = Shared(docs, first, second)

    @F.arrow_udf("string")
    def grouped(texts: pa.Array) -> pa.Array:
        aligner = shared.aligner()
        return pa.array([text for part in text_slices(texts, SLICE) for text in aligner.linked(part).groups], pa.string())

    return docs.select("doc_id", grouped(F.col("text")).alias("groups"))


def packed(slots: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of sorted slots, one per start, as flat bytes and the end of each.

    The first byte of a bitmap tells its form: 0 for a list of 16-bit slots, 1 for bits.
    """
    counts = np.diff(np.append(starts, len(slots)))
    width = (size + 7) // 8
    dense = 2 * counts > width
    ends = np.cumsum(1 + np.where(dense, width, 2 * counts))
    begin = np.concatenate([[0], ends])[:-1]
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    out[begin] = dense
    listed = ~np.repeat(dense, counts)
    place = np.repeat(begin + 1 - 2 * starts, counts)[listed] + 2 * np.flatnonzero(listed)
    out[place], out[place + 1] = slots[listed] & 0xFF, slots[listed] >> 8
    for k in np.flatnonzero(dense):
        bits = np.zeros(8 * width, dtype=np.uint8)
        bits[slots[starts[k] : starts[k] + counts[k]]] = 1
        out[begin[k] + 1 : ends[k]] = np.packbits(bits, bitorder="little")
    return out, ends


def unpacked(bits: bytes) -> np.ndarray:
    """The slots of one bitmap."""
    if bits[0]:
        return np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8, offset=1), bitorder="little"))
    return np.frombuffer(bits, "<u2", offset=1).astype(np.int64)


class Block:
    """The documents and postings of a block while its slices are read."""

    def __init__(self, number: int):
        self.number = number
        self.documents: list[tuple] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.postings = 0

    def add(self, ids: list, aligner: Aligner, texts: list[str]) -> None:
        found = aligner.linked(texts)
        slot = found.text + len(self.documents)
        keys, times = np.unique(found.pair * BLOCK_DOCS + slot, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self.postings += len(keys)
        digests = [sha256(text.encode()).hexdigest() if text else "" for text in found.groups]
        self.documents += zip(ids, *found.counts.T.tolist(), digests)

    def rows(self) -> Iterator[pa.RecordBatch]:
        n = len(self.documents)
        columns = list(zip(*self.documents))
        yield self._batch(n, plane=pa.array(np.full(n, DOCUMENT), pa.int32()), slot=pa.array(np.arange(n), pa.int32()),
                          **dict(zip(["doc_id", *COUNTS, "groups_sha256"], map(list, columns))))
        # Slices hold different documents, so that the OR of their bitmaps is the sorted union.
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys)
        keys, times = keys[order], times[order] - 1
        self.keys, self.times = [], []
        yield from self._plane(keys, 0, n)
        plane = 1
        while len(keys):
            yield from self._plane(keys[(times & 1) == 1], plane, n)
            keys, times = keys[times > 1], times[times > 1] >> 1
            plane += 1

    def _plane(self, keys: np.ndarray, plane: int, n: int) -> Iterator[pa.RecordBatch]:
        pair = keys // BLOCK_DOCS
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        for at in range(0, len(starts), ROWS_OUT):
            some = starts[at : at + ROWS_OUT]
            stop = starts[at + ROWS_OUT] if at + ROWS_OUT < len(starts) else len(keys)
            data, ends = packed(keys[some[0] : stop] % BLOCK_DOCS, some - some[0], n)
            bits = pa.Array.from_buffers(pa.binary(), len(some), [
                None, pa.py_buffer(np.append(0, ends).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
            counts = np.diff(np.append(some, stop))
            yield self._batch(len(some), plane=pa.array(np.full(len(some), plane), pa.int32()), pair=pair[some], n=counts, bits=bits)

    def _batch(self, size: int, **columns) -> pa.RecordBatch:
        columns["block"] = np.full(size, self.number)
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in INDEX], schema=INDEX)


def _indexed(shared: Shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, first = shared.aligner(), TaskContext.get().partitionId() << 32
        block = Block(first)
        for batch in batches:
            ids, at = batch.column(0).to_pylist(), 0
            for part in text_slices(batch.column(1), SLICE):
                for k in range(0, len(part), BLOCK_DOCS):
                    some = part[k : k + BLOCK_DOCS]
                    if block.documents and len(block.documents) + len(some) > BLOCK_DOCS:
                        yield from block.rows()
                        block = Block(block.number + 1)
                    block.add(ids[at : at + len(some)], aligner, some)
                    at += len(some)
                if block.postings >= BLOCK_POSTINGS:
                    yield from block.rows()
                    block = Block(block.number + 1)
        if block.documents:
            yield from block.rows()

    return run


SCHEMA = "block long, plane int, slot int, doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + (
    ", groups_sha256 string, pair long, n long, bits binary")


def index(docs: DataFrame, shared: Shared) -> DataFrame:
    """Rows of the documents (plane -1) and of the bitmaps, as a table: one attempt of a task counts."""
    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_indexed(shared), SCHEMA)
    return written(rows, "pair-bitmaps")


def pair_scores(postings: DataFrame, size_b: int) -> DataFrame:
    """pair, its documents and links, and whether no pair of its second id has more links."""
    weight = F.expr("CASE WHEN plane = 0 THEN 1L ELSE shiftleft(1L, plane - 1) END")
    counts = postings.where("plane >= 0").groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("docs"), F.sum(F.col("n") * weight).alias("links"))
    b = F.col("pair") % size_b
    most = counts.groupBy(b.alias("b")).agg(F.max("links").alias("most"))
    return counts.join(most, b == F.col("b")).select("pair", "docs", "links", (F.col("links") == F.col("most")).alias("best"))


class Sums:
    """The scores of the documents of one block."""

    def __init__(self):
        self.documents: list[pa.RecordBatch] = []
        self.totals = np.zeros((2, 3, BLOCK_DOCS), dtype=np.int64)  # low and high halves

    def add(self, rows: pa.RecordBatch) -> None:
        planes = rows.column("plane").to_numpy()
        if (described := int(np.searchsorted(planes, 0))) > 0:
            self.documents.append(rows.slice(0, described))
        rows = rows.slice(described)
        if rows.num_rows == 0:
            return
        weight = np.left_shift(1, np.maximum(planes[described:].astype(np.int64) - 1, 0))
        links = rows.column("links").to_numpy()
        values = np.stack([
            weight * links, weight * rows.column("best").to_numpy(zero_copy_only=False), weight * rows.column("docs").to_numpy()])
        listed, owner = [], []
        for k, bits in enumerate(rows.column("bits")):
            slots = unpacked(bits.as_buffer())
            listed.append(slots)
            owner.append(len(slots))
        slots, row = np.concatenate(listed), np.repeat(np.arange(len(owner)), owner)
        for half, part in enumerate((values & ((1 << LOW) - 1), values >> LOW)):
            for k in range(len(values)):
                self.totals[half, k] += np.bincount(slots, part[k][row], minlength=BLOCK_DOCS).astype(np.int64)

    def rows(self) -> pa.RecordBatch:
        documents = pa.Table.from_batches(self.documents).combine_chunks()
        slot = documents.column("slot").to_numpy()
        sums = (self.totals[0] + (self.totals[1] << LOW))[:, slot]
        names = ["doc_id", *COUNTS, "groups_sha256"]
        columns = [documents.column(c).combine_chunks() for c in names] + [pa.array(s) for s in sums]
        return pa.RecordBatch.from_arrays(columns, [*names, "count_sum", "n_best", "doc_sum"])


def _summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by block and plane, so a block's documents are first."""
    at, sums = None, Sums()
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        starts = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
        for i, j in zip(starts, [*starts[1:], len(blocks)]):
            if at is not None and blocks[i] != at:
                yield sums.rows()
                sums = Sums()
            at = blocks[i]
            sums.add(batch.slice(i, j - i))
    if at is not None:
        yield sums.rows()


def alignment_digests(docs: DataFrame, first: str, second: str) -> DataFrame:
    """Per document its counts, groups_sha256, and sums over its links.

    ``count_sum`` adds the links of each linked pair in all documents, ``doc_sum`` its documents,
    and ``n_best`` counts the links whose pair has the most links of its second id.
    """
    shared = Shared(docs, first, second)
    table = index(docs, shared)
    size_b = len(sentencepiece.SentencePieceProcessor(model_file=second))
    scores = pair_scores(table, size_b)
    described = table.where("plane < 0").select(
        "block", "plane", "slot", "doc_id", *COUNTS, "groups_sha256", *[
            F.lit(None).cast(t).alias(c) for c, t in (("bits", "binary"), ("links", "long"), ("best", "boolean"), ("docs", "long"))])
    postings = table.where("plane >= 0").select("block", "plane", "pair", "bits").join(scores, "pair").select(
        "block", "plane", *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in ("slot", "doc_id", *COUNTS, "groups_sha256")],
        "bits", "links", "best", "docs")
    dealt = described.unionByName(postings).repartition("block").sortWithinPartitions("block", "plane")
    kinds = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", groups_sha256 string, count_sum long, n_best long, doc_sum long"
    return dealt.mapInArrow(_summed, kinds)
