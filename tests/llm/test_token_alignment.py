import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
import sentencepiece
from conftest import DATA
from llm_data import make_docs, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tidemark.llm import token_alignment as align
from tidemark.llm.byte_bpe import byte_of_sign

FIRST, SECOND = vocabularies.path("byte_bpe_50k.json"), vocabularies.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND)


def spans(ids, pieces):
    out, at = [], 0
    for i, p in zip(ids, pieces):
        out.append((at, at + len(p), i))
        at += len(p)
    return out


def one(text, first, second):
    """n_a, n_b, groups and the links of one text by comparing all ranges, or None."""
    sign = byte_of_sign()
    names = {i: t for t, i in first.get_vocab().items()}
    if not text:
        return None
    a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
    pieces_a = [bytes(sign[c] for c in names[i]) for i in a]
    pieces_b = [
        bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if not b"".join(pieces_a) == b"".join(pieces_b) == (" " + text).encode():
        return None
    a, b = spans(a, pieces_a), spans(b, pieces_b)
    links = [(i, j) for s, e, i in a for t, f, j in b if s < f and t < e]
    groups, begin = [], 0
    for cut in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
        groups.append("|".join(",".join(str(i) for s, e, i in side if begin < e <= cut) for side in (a, b)))
        begin = cut
    return len(a), len(b), groups, links


def brute(rows, first, second):
    found = [(i, one(t, first, second)) for i, t in rows]
    counts, docs = Counter(), Counter()
    for _, x in found:
        if x:
            counts.update(x[3])
            docs.update(set(x[3]))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = x[3]
        out.append((
            i, x[0], x[1], len(x[2]), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
            sum(docs[p] for p in links), hashlib.sha256(";".join(x[2]).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "doc_sum", "groups_sha256"]
    return sorted(map(tuple, df.select(*names).collect()), key=repr)


ODD = [
    None, "", " ", "a", "\n\n", "a ▁ b", "\0", "<|endoftext|> x <s> </s> <unk> <0x41>", "日本 😀 é ﻿", "  two  spaces ", "\t x",
    "tokenization of antidisestablishmentarianism", "aaaaaaaaaaaaaaaa" * 5, "1234567890" * 7, "́é",
]


def rows():
    return list(enumerate(ODD)) + [(k, prose(k, 12, 30)) for k in range(20, 45)] + [(20, "other text"), (None, "no id"), (21, "other text")]


@pytest.mark.parametrize("docs,postings", [(1 << 16, 1 << 22), (4, 1 << 22), (1 << 16, 10)])
def test_equals_brute_force(spark, tokenizers, monkeypatch, docs, postings):
    """With blocks of few documents or postings, the bitmaps of many blocks make the same scores."""
    limits = {"BLOCK_DOCS": docs, "BLOCK_POSTINGS": postings}
    frame = make_docs(spark, rows()).withColumn("pair", F.lit("mine")).withColumn("block", F.lit(1)).coalesce(2)
    if docs == 4:
        monkeypatch.setattr(align, "SLICE", 1)
    shared = align.Shared(frame, FIRST, SECOND)
    monkeypatch.setattr(align, "Shared", lambda *_: shared)
    for name, value in limits.items():
        monkeypatch.setattr(align, name, value)
    assert result(align.alignment_digests(frame, FIRST, SECOND)) == brute(rows(), *tokenizers)


def aligner():
    return align.Aligner(open(FIRST, "rb").read(), open(SECOND, "rb").read())


class Counted:
    """The second tokenizer, with the number of characters it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, 0

    def encode(self, texts, **options):
        self.given += sum(map(len, texts))
        return self.tokenizer.encode(texts, **options)


def test_a_piece_is_tokenized_once():
    """The tokenizers' work follows the different pieces, not all texts."""
    rnd = random.Random(4)
    words = prose(1, 60).split()
    texts = [" ".join(rnd.choice(words) for _ in range(50)) for _ in range(200)]
    tables = aligner()
    tables.second = Counted(tables.second)
    block = align.Block(0)
    for k in range(0, len(texts), 20):
        block.add(list(range(k, k + 20)), tables, texts[k : k + 20])
    assert len(block.documents) == 200 and 0 < tables.second.given < 2000 < 20 * 2000 < sum(map(len, texts))


JOINTS = [
    " ", "  ", "   ", "\n", "\n ", " \n", "\t", "\r", "\x1c", "\x85", "\xa0", "\u3000", "\u200b", "▁", "▁ ", " ▁", "'s", "'", "the", "Word", "12",
    "=", "</s>", "<0x41>", "<|endoftext|>", "é", "e\u0301", "\u0301", "日本", "😀", "\0", "\u0378", "ab" * 40, ". ", ", "]


@pytest.mark.parametrize("cached", [1 << 18, 30])
def test_pieces_give_what_whole_texts_give(monkeypatch, cached):
    monkeypatch.setattr(align, "CACHED", cached)
    rnd = random.Random(6)
    some = [rnd.choice([JOINTS, [" ", "the", "ing", "a", "\n", ". "]]) for _ in range(3000)]
    texts = ["".join(rnd.choice(s) for _ in range(rnd.randrange(15))) for s in some] + [t or "" for t in ODD] + [prose(3, 200)]
    cut, whole = aligner(), aligner()
    whole.apart, whole._cut = False, lambda text: [text]
    assert cut.apart
    for k in range(0, len(texts), 500):
        got, want = cut.linked(texts[k : k + 500]), whole.linked(texts[k : k + 500])
        assert got.groups == want.groups
        for name in ("counts", "text", "pair"):
            assert (getattr(got, name) == getattr(want, name)).all()
    assert 0 < len(cut._held.number) == len(cut._held.groups) < len(texts)
    assert max(map(len, cut._held.number)) <= align.LONG


def test_group_texts(spark, tokenizers):
    got = {(r.doc_id, r.groups) for r in align.groups(make_docs(spark, rows()), FIRST, SECOND).collect()}
    want = set()
    for i, text in rows():
        x = one(text, *tokenizers)
        want.add((i, ";".join(x[2]) if x else ""))
    assert got == want


def test_empty_table(spark):
    assert align.alignment_digests(make_docs(spark, ["a"]).limit(0), FIRST, SECOND).collect() == []


def test_a_very_long_text(spark):
    text = prose(1, 100_000)
    (row,) = align.alignment_digests(make_docs(spark, [text]), FIRST, SECOND).collect()
    assert row.n_a + row.n_b == row.n_groups + row.n_links and row.n_best > 0


def test_copies_count_each(spark, tokenizers):
    docs = [(k, "hot text of many copies") for k in range(300)] + [(900, "text of one")]
    assert result(align.alignment_digests(make_docs(spark, docs), FIRST, SECOND)) == brute(docs, *tokenizers)


@pytest.mark.parametrize("size", [1, 16, 300, 1 << 16])
def test_bitmaps_round_trip(size):
    rng = np.random.default_rng(size)
    sets = [np.sort(rng.choice(size, rng.integers(1, size + 1), replace=False)) for _ in range(30)]
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    data, ends = align.packed(np.concatenate(sets), starts, size)
    begin = np.concatenate([[0], ends])
    for k, s in enumerate(sets):
        bits = data[begin[k]:begin[k + 1]].tobytes()
        assert align.unpacked(bits).tolist() == s.tolist()
        assert len(bits) <= 1 + min(2 * len(s), (size + 7) // 8)


def test_large_scores_stay_exact():
    """Sums beyond 2^53 of doubles are kept in halves."""
    sums = align.Sums()
    import pyarrow as pa

    big = 2**55 + 1
    bits, _ = align.packed(np.array([3]), np.array([0]), 8)
    rows = pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int32()), pa.array([bits.tobytes()], pa.binary()), pa.array([big]), pa.array([True]), pa.array([5])],
        ["plane", "bits", "links", "best", "docs"])
    for _ in range(3):
        sums.add(rows)
    total = sums.totals[0] + (sums.totals[1] << align.LOW)
    assert total[:, 3].tolist() == [3 * big, 3, 15]


def test_the_query_equals_brute_force(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy(F.length("text")).limit(120)
    small = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(align.alignment_digests(docs, FIRST, SECOND)) == brute(small, *tokenizers)
    whole = contract.queries()["op11_token_alignment"](spark, DATA)
    assert whole.where("n_links <> n_a + n_b - n_groups").isEmpty() and whole.where("n_links > 0").count() > 900
