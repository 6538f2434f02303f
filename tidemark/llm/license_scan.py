"""License notices in documents: winnowed fingerprints, then banded alignment.

Of the hashes of all runs of a few words of a template the least of every window of neighbours are
its fingerprints; an inverted index maps them to templates and places. A notice that keeps the
coverage may have ``floor((1 - coverage) m)`` of its ``m`` words replaced, so some run of words between
them is intact; the size of grams (``GRAM`` at most) and of the window are chosen per template so that
an intact run of that length always holds a fingerprint. All runs
of a document are looked up. Hits of a template that lie within ``BAND`` of one diagonal are a
candidate if enough of the template's words stand there at all. Then the words of template
and document are aligned (local alignment, match +2, mismatch and gap -1) inside the band; the
result is how many template words match, and where the match begins and ends in the text.

The index holds the templates only and has a fixed size; documents stay where they are read.

A row per notice: doc_id, template, matched, total, coverage, start and end (characters, end
exclusive). Words are runs of letters and digits, ASCII letters in lower case. Defined cases:
null and empty texts have no notice; each repetition of a notice is reported, in each repeated
row; overlapping finds of one template are reported once, the better one; a template of fewer
than ``GRAM`` words is refused; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.license_templates import TEMPLATES
from tidemark.llm.text_hash import PUNCTUATION, U, Words, mix, word_slices

GRAM = 3
BAND = 12
COVERAGE = 0.8
MATCH, MISS = 2, -1
SCHEMA = "doc_id long, template string, matched long, total long, coverage double, start long, end long"


def _grams(h: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(h) - size + 1)
    total = np.full(n, size, dtype=U)
    for k in range(size):
        total = mix(total + h[k : k + n])
    return total


def intact(words: int, coverage: float) -> int:
    """Words of the longest run that is sure to be intact when the coverage is kept."""
    changed = int((1 - coverage) * words + 1e-9)
    return -(-(words - changed) // (changed + 1))


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hash, the last of equal ones, in each window of neighbours."""
    if len(hashes) == 0:
        return np.zeros(0, np.int64)
    width = min(window, len(hashes))
    seen = np.lib.stride_tricks.sliding_window_view(hashes, width)
    least = width - 1 - np.argmin(seen[:, ::-1], axis=1)
    return np.unique(least + np.arange(len(seen)))


@dataclass
class Index:
    """Sorted fingerprints with the template and the word each begins at."""

    names: list[str]
    words: list[np.ndarray]
    sizes: list[int]  # of grams
    prints: np.ndarray
    template: np.ndarray
    place: np.ndarray
    known: np.ndarray  # the distinct fingerprints


def build_index(templates: dict[str, str], coverage: float = COVERAGE) -> Index:
    names, words, rows = list(templates), [], []
    sizes = set()
    for number, text in enumerate(templates.values()):
        h = next(word_slices(pa.array([text]), lower=True, blank=PUNCTUATION)).hash
        if len(h) < GRAM:
            raise ValueError(f"template {names[number]!r} has fewer than {GRAM} words")
        run = intact(len(h), coverage)
        size = min(GRAM, run)
        sizes.add(size)
        grams = _grams(h, size)
        words.append(h)
        rows += [(int(grams[p]), number, int(p)) for p in winnowed(grams, run - size + 1)]
    rows.sort()
    prints = np.array([r[0] for r in rows], dtype=U)
    return Index(
        names, words, sorted(sizes), prints, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.unique(prints))


def align(template: np.ndarray, text: np.ndarray, diagonal: int) -> tuple[int, int, int, int]:
    """Score, matched words, first and last matched word of the text near ``template + diagonal``."""
    m, width = len(template), 2 * BAND + 1
    offset = np.arange(width)
    rows = [np.zeros(width + 1, dtype=np.int64)]
    equal = []
    for i in range(m):
        j = i + diagonal - BAND + offset
        inside = (j >= 0) & (j < len(text))
        same = np.zeros(width, dtype=bool)
        same[inside] = text[j[inside]] == template[i]
        above = rows[-1]
        best = np.maximum(above[:width] + np.where(same, MATCH, MISS), above[1:] + MISS)
        best = np.maximum(best, 0)
        run = np.maximum.accumulate(best - MISS * offset) + MISS * offset  # gaps along the text
        row = np.zeros(width + 1, dtype=np.int64)
        row[:width] = np.where(inside, np.maximum(run, 0), 0)
        rows.append(row)
        equal.append(same)
    table = np.stack(rows)
    i, d = np.unravel_index(int(np.argmax(table[:, :width])), (m + 1, width))
    score, matched, first, last = int(table[i, d]), 0, -1, -1
    while i > 0 and table[i, d] > 0:
        here = table[i, d]
        if equal[i - 1][d] and here == table[i - 1, d] + MATCH:
            first = int(i - 1 + diagonal - BAND + d)
            last = first if last < 0 else last
            matched, i = matched + 1, i - 1
        elif here == table[i - 1, d] + MISS:
            i -= 1
        elif here == table[i - 1, d + 1] + MISS:
            i, d = i - 1, d + 1
        elif d > 0 and here == table[i, d - 1] + MISS:
            d -= 1
        else:
            break
    return score, matched, first, last


def _candidates(words: Words, index: Index) -> Iterator[tuple[int, int, int]]:
    """(text, template, diagonal) where fingerprints of a template gather around a diagonal."""
    found = []
    for size in index.sizes:
        grams = _grams(words.hash, size)
        at = np.minimum(np.searchsorted(index.known, grams), len(index.known) - 1)
        hits = np.flatnonzero(index.known[at] == grams)
        doc = np.searchsorted(words.first, hits, side="right") - 1
        inside = hits + size <= words.first[doc + 1]
        found.append((hits[inside], doc[inside], grams[hits[inside]]))
    hits, doc, grams = (np.concatenate(x) for x in zip(*found))
    begin = np.searchsorted(index.prints, grams, side="left")
    end = np.searchsorted(index.prints, grams, side="right")
    many = end - begin
    which = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    doc, hits = np.repeat(doc, many), np.repeat(hits, many)
    template = index.template[which]
    diagonal = hits - words.first[doc] - index.place[which]
    order = np.lexsort((diagonal, template, doc))
    before = None
    for d, t, g in zip(doc[order].tolist(), template[order].tolist(), diagonal[order].tolist()):
        if before is None or before[:2] != (d, t) or g - before[2] > BAND:
            before = (d, t, g)
            yield before


def _finds(words: Words, index: Index, coverage: float) -> list[tuple]:
    found: dict[tuple[int, int], list] = {}
    for d, t, diagonal in _candidates(words, index):
        template = index.words[t]
        begin = words.first[d]
        near = words.hash[max(begin, begin + diagonal - BAND) : min(words.first[d + 1], begin + diagonal + len(template) + BAND)]
        if np.isin(template, near).sum() < coverage * len(template):
            continue
        text = words.hash[begin : words.first[d + 1]].copy()
        while True:  # a notice may stand in the band more than once
            _, matched, first, last = align(index.words[t], text, diagonal)
            if matched < coverage * len(index.words[t]):
                break
            text[first : last + 1] = 0
            same = found.setdefault((d, t), [])
            clash = [x for x in same if x[1] <= last and first <= x[2]]
            if all(matched > x[0] for x in clash):
                for x in clash:
                    same.remove(x)
                same.append((matched, first, last))
    return [(d, t, *x) for (d, t), finds in found.items() for x in sorted(finds, key=lambda x: x[1])]


def scan_batches(index: Index, coverage: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for words in word_slices(batch.column(1), lower=True, blank=PUNCTUATION):
                finds = _finds(words, index, coverage)
                if not finds:
                    continue
                # Bytes that begin a character, counted to turn byte offsets into characters.
                chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
                for d, t, matched, first, last in finds:
                    w = words.first[d]
                    zero = chars[words.text_begin[d]]
                    total = len(index.words[t])
                    rows.append((
                        batch.column(0)[words.begin + d].as_py(), index.names[t], matched, total,
                        round(matched / total, 6), int(chars[words.start[w + first]] - zero),
                        int(chars[words.end[w + last]] - zero)))
            names = ["doc_id", "template", "matched", "total", "coverage", "start", "end"]
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """A row per notice found; see the module for the columns."""
    index = build_index(templates, coverage)
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(scan_batches(index, coverage), SCHEMA)
