import hashlib
import random

import numpy as np
import public_tokenizers as vocabularies
import pytest
from conftest import DATA
from llm_data import make_docs, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from tidemark.llm import bpe_codec as codec
from tidemark.llm import byte_bpe

PATH = vocabularies.path("byte_bpe_50k.json")
PIECES = [
    "a", "aaaa", "ab", "the", "ing", "  ", "\n", "\t", "!!", "--", "é", "ß", "中", "日本", "😀", "1", "333", "'s", "'re",
    "<|endoftext|>", "<|endof", "▁", "\0", "\xa0", "　", "\U000323b5", "՘", "x" * 40, "====", "Ġ", "\x1c", "\x85", "ab" * 7,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tables():
    return byte_bpe.ByteBpe(open(PATH, "rb").read())


def mixed(n, seed=1):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(50))) for _ in range(n)]
    texts += ["".join(rnd.choice("ab") for _ in range(rnd.randrange(40))) for _ in range(n)]
    points = [lambda: rnd.randrange(1, 0x250), lambda: rnd.randrange(0x250, 0xD800), lambda: rnd.randrange(0xE000, 0x110000)]
    texts += ["".join(chr(rnd.choice(points)()) for _ in range(rnd.randrange(30))) for _ in range(n)]
    return texts + ["a" * i for i in range(150)] + ["=" * i for i in range(150)] + [" " * i for i in range(150)]


def test_ids_are_those_of_the_library(tables, library):
    texts = mixed(1500) + ["ab" * 20_000, "x" * 100_000, " " * 50_000, prose(1, 50_000)]
    got = [np.frombuffer(x, np.int32).tolist() for x in tables.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert 0 < tables.merged_words < tables.proposed_words  # both ways are taken


def test_special_strings_as_plain_text(library):
    plain = byte_bpe.ByteBpe(open(PATH, "rb").read(), special=False)
    texts = ["a<|endoftext|>b", "<|endoftext|>"]
    other = Tokenizer.from_file(PATH)
    other.encode_special_tokens = True
    assert [np.frombuffer(x, np.int32).tolist() for x in plain.encode(texts)] == [
        e.ids for e in other.encode_batch(texts, add_special_tokens=False)]


def test_compatible_pairs_are_those_that_merging_keeps(tables):
    """The vectorised test of a pair against merging its joined bytes."""
    rng = np.random.default_rng(3)
    common = rng.integers(0, 2000, 3000)
    left = np.concatenate([rng.integers(0, 50256, 2000), common])
    right = np.concatenate([rng.integers(0, 50256, 2000), rng.permutation(common)])
    fine = tables.pairs.compatible(left, right)
    joined = [(tables.tokens[a] + tables.tokens[b]).decode("latin-1") for a, b in zip(left, right)]
    want = [np.frombuffer(tables._merged_long(w), np.int32).tolist() == [a, b] for w, a, b in zip(joined, left, right)]
    assert fine.tolist() == want and 0 < fine.sum() < len(fine)


def test_both_ways_of_merging_agree(tables):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abing \xc3\xa9=") for _ in range(rnd.randrange(1, 60))) for _ in range(500)]
    assert tables._merged(words) == [tables._merged_long(w) for w in words]


def test_a_merge_ranks_only_the_pairs_beside_it(tables, monkeypatch):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abing \xc3\xa9=") for _ in range(60)) for _ in range(200)]
    asked, rank = [], tables.pairs.rank
    monkeypatch.setattr(tables.pairs, "rank", lambda left, right: asked.append(len(left)) or rank(left, right))
    assert tables._merged(words) and sum(asked) < 3 * 60 * 200


def test_words_kept_are_bounded(monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "CACHED", 50)
    tables = byte_bpe.ByteBpe(open(PATH, "rb").read())
    for k in range(20):
        (ids,) = tables.encode([prose(k, 30) + "<|endoftext|>"])
        assert np.frombuffer(ids, np.int32).tolist() == library.encode(prose(k, 30) + "<|endoftext|>").ids
        assert len(tables._kept) <= 50 + 31


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.ByteBpe(open(vocabularies.path("word_bpe_49k.json"), "rb").read())


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, rows):
    out = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    return sorted(out, key=repr)


def test_odd_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (3, "b"), (None, "c <|endoftext|> d"), (4, prose(1, 100_000)), (5, "\0")]
    docs = make_docs(spark, rows).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))
    got = codec.digests(docs, PATH).collect()
    assert sorted(map(tuple, got), key=repr) == expected(library, rows)
    assert codec.digests(docs.limit(0), PATH).collect() == []


def test_columns_stay_beside_the_ids(spark, library):
    docs = make_docs(spark, ["one two", None]).withColumn("ids", F.lit("mine"))
    vocabulary = codec.Vocabulary(docs, PATH)
    got = docs.withColumn("tokens", codec.encoded(vocabulary, F.col("text"))).orderBy("doc_id").collect()
    assert [(r.ids, r.tokens) for r in got] == [("mine", library.encode("one two").ids), ("mine", [])]


def test_ids_that_are_no_text(spark):
    rows = spark.createDataFrame([([220, 50256, 188],), (None,), ([],)], "ids array<int>")
    vocabulary = codec.Vocabulary(rows, PATH)
    got = [r.d for r in rows.select(codec.decoded(vocabulary, F.col("ids")).alias("d")).collect()]
    assert got == [" <|endoftext|>" + Tokenizer.from_file(PATH).decode([188]), "", ""]


def test_each_text_is_encoded_once(spark):
    docs = make_docs(spark, ["a"])
    vocabulary = codec.Vocabulary(docs, PATH)
    ids = docs.select(codec.encoded(vocabulary, F.col("text")).alias("ids"))
    apart = ids.select("ids", codec.decoded(vocabulary, F.col("ids")).alias("decoded"))
    for df, call in ((codec.digests(docs, PATH), "there_and_back(text"), (apart, "encode(text")):
        assert df._jdf.queryExecution().executedPlan().toString().count(call) == 1


def test_the_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    got = contract.queries()["op12_bpe_codec"](spark, DATA).collect()
    assert sorted(map(tuple, got), key=repr) == expected(library, [(r.doc_id, r.text) for r in docs])
