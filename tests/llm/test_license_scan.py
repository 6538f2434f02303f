import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_data import changed, make_docs, prose
from pyspark.sql import functions as F

from tidemark.llm import license_scan as scan
from tidemark.llm.license_templates import TEMPLATES
from tidemark.llm.text_hash import PUNCTUATION, word_slices


def found(spark, *texts):
    return [tuple(r)[:5] + (r.start, r.end) for r in scan.scan_licenses(make_docs(spark, texts)).orderBy("doc_id", "start").collect()]


def test_spans_point_at_the_notice(spark):
    texts = [
        "Été. ALL rights\nreserved. " + prose(1), prose(2), None, "",
        prose(3) + " " + TEMPLATES["isc"] + " " + prose(4), "x All rights reserved. y All Rights Reserved z",
    ]
    got = found(spark, *texts)
    assert [(d, t, m) for d, t, m, *_ in got] == [
        (0, "all-rights-reserved", 3), (4, "isc", 34), (5, "all-rights-reserved", 3), (5, "all-rights-reserved", 3)]
    for d, _, _, _, coverage, start, end in got:
        assert coverage == 1.0
    assert texts[0][got[0][5]:got[0][6]] == "ALL rights\nreserved"
    assert texts[4][got[1][5]:got[1][6]] == TEMPLATES["isc"].rstrip(".")


def test_changed_notice_is_found_and_measured(spark):
    text = prose(5) + " " + changed(TEMPLATES["bsd-2-clause"], 6) + " " + prose(6)
    ((_, name, matched, total, coverage, _, _),) = found(spark, text)
    assert (name, matched, total) == ("bsd-2-clause", total - 6, 68) and coverage == round(matched / 68, 6)
    assert not found(spark, prose(5) + " " + changed(TEMPLATES["bsd-2-clause"], 30))


def test_repeated_rows_are_reported_each(spark):
    docs = make_docs(spark, [(7, "All rights reserved."), (7, "All rights reserved."), (None, "All rights reserved.")])
    assert sorted(str(r.doc_id) for r in scan.scan_licenses(docs).collect()) == ["7", "7", "None"]


def test_long_text(spark):
    text = prose(1, 300_000) + " Released under the MIT License. " + prose(2, 1000)
    ((_, name, *_, start, end),) = found(spark, text)
    assert name == "mit-notice" and text[start:end] == "Released under the MIT License"


def brute(template, text):
    """Best local alignment without a band: matched words of an optimal path."""
    m, n = len(template), len(text)
    best = np.zeros((m + 1, n + 1), dtype=int)
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            step = scan.MATCH if template[i - 1] == text[j - 1] else scan.MISS
            best[i, j] = max(0, best[i - 1, j - 1] + step, best[i - 1, j] + scan.MISS, best[i, j - 1] + scan.MISS)
    return best.max()


@pytest.mark.parametrize("seed", range(5))
def test_alignment_equals_full_table(seed):
    def hashes(text):
        return next(word_slices(pa.array([text]), lower=True, blank=PUNCTUATION)).hash

    template = hashes(TEMPLATES["isc"])
    words = changed(TEMPLATES["isc"], 4, seed).split()
    del words[10]
    words.insert(20, "inserted")
    text = hashes(prose(seed, 15) + " " + " ".join(words) + " " + prose(seed + 9, 15))
    score, matched, first, last = scan.align(template, text, 15)
    assert score == brute(template, text) and matched >= len(template) - 5
    assert first >= 15 and last < len(text) - 15


def test_winnowing_selects_from_every_window():
    h = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    places = scan.winnowed(h, 4)
    assert all(any(i <= p < i + 4 for p in places) for i in range(len(h) - 3))


SHORT = {k: v for k, v in TEMPLATES.items() if len(v.split()) < 30}


@pytest.mark.parametrize("name", sorted(SHORT))
def test_short_notices_with_changed_words(spark, name):
    """As many words as the coverage allows are replaced, one after the other and spread over the notice."""
    words = re.findall(r"[^\W_]+", SHORT[name])
    spare = int(0.2 * len(words) + 1e-9)
    texts = []
    if spare:
        for first in range(len(words)):
            other = [w if (k - first) % -(-len(words) // spare) or k < first else f"other{k}" for k, w in enumerate(words)]
            texts.append(prose(1, 30) + " " + " ".join(other) + " " + prose(2, 30))
    got = scan.scan_licenses(make_docs(spark, [SHORT[name], *texts])).where(F.col("template") == name).collect()
    assert {r.doc_id for r in got} == set(range(len(texts) + 1))


def every_diagonal(templates, texts, coverage=0.8):
    """(text, template) pairs whose alignment reaches the coverage on any diagonal, without fingerprints."""
    out = set()
    for i, text in enumerate(texts):
        h = word_hashes(text)
        for name, notice in templates.items():
            t = word_hashes(notice)
            for diagonal in range(-len(t), len(h) + 1, scan.BAND):
                if scan.align(t, h, diagonal)[1] >= coverage * len(t):
                    out.add((i, name))
                    break
    return out


def word_hashes(text):
    return next(word_slices(pa.array([text]), lower=True, blank=PUNCTUATION)).hash


def test_candidates_lose_nothing_that_a_scan_of_all_diagonals_finds(spark):
    rnd = random.Random(4)
    texts = []
    for k in range(60):
        words = re.findall(r"[^\W_]+", SHORT[sorted(SHORT)[k % len(SHORT)]])
        for _ in range(rnd.randrange(3)):
            words[rnd.randrange(len(words))] = f"z{rnd.randrange(99)}"
        texts.append(prose(k, 10) + " " + " ".join(words) + " " + prose(k + 100, 12))
    got = scan.scan_licenses(make_docs(spark, texts), SHORT).collect()
    assert {(r.doc_id, r.template) for r in got} == every_diagonal(SHORT, texts)


def test_short_template_is_refused():
    with pytest.raises(ValueError):
        scan.build_index({"x": "two words"})
