import random

import regex
import zstandard
from llm_data import DOCS
from pyspark.sql import functions as F

from tidemark.llm import langid

DATA = "/root/testdata/sf0.1"
SOUNDS = {"aa": ["lo", "mi", "ra", "te"], "bb": ["sch", "ung", "pf", "ein"], "cc": ["ción", "ñu", "ll", "que"]}


def say(lang, seed, words=40):
    rnd = random.Random(f"{lang}{seed}")
    return " ".join("".join(rnd.choice(SOUNDS[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(words))


def case(spark):
    rows = [(i, say(lang, i), lang, "s", 0) for i, lang in ((i, list(SOUNDS)[i % 3]) for i in range(150))]
    rows += [(200, None, "aa", "s", 0), (201, "", "aa", "s", 0), (202, "123 !! \n", "bb", "s", 0),
             (203, say("bb", 7, 60_000), None, "s", 0), (203, say("cc", 9).upper(), None, "s", 0), (None, say("aa", 5), None, "s", 0)]
    return spark.createDataFrame(rows, DOCS)


def test_languages(spark):
    docs = case(spark)
    got = langid.predict_languages(docs).collect()
    assert len(got) == 156 and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == list(SOUNDS)[i % 3] and by_id[i].reliable for i in range(150))
    assert all(tuple(by_id[i])[2:4] == ("und", 0.0) for i in (200, 201, 202))
    assert sorted(r.lang_pred for r in got if r.doc_id == 203) == ["bb", "cc"]
    assert [r.lang_pred for r in got if r.doc_id is None] == ["aa"]


def test_held_out_rows_and_other_columns_are_not_used(spark):
    docs = case(spark).where("doc_id IS NOT NULL")
    held = langid.held_out(F.col("doc_id"))
    other = docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    a, b = (langid.predict_languages(d).orderBy("doc_id", "score").collect() for d in (docs, other))
    assert a == b


def test_no_or_one_language(spark):
    docs = case(spark)
    none = langid.predict_languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    one = langid.predict_languages(docs.withColumn("lang", F.lit("only"))).where("lang_pred <> 'und'")
    assert {(r.lang_pred, r.score) for r in one.collect()} == {("only", 1.0)}


def test_sample_is_bounded_and_whole_texts_are_judged(spark):
    docs = case(spark)
    parts = langid.training_texts(docs, texts=5, piece=30).collect()
    assert max(len(p.part) for p in parts) <= 30
    assert all(sum(p.lang == x for p in parts) == 5 for x in SOUNDS)
    contents = langid.dictionaries(docs)
    judge = langid.Compressors(contents)
    text = say("aa", 1, 20) + " " + say("bb", 2, 4000)
    assert judge.judge(text.encode())[0] == "bb"  # the beginning does not decide


def test_pieces_come_from_whole_texts(spark):
    """Of texts that begin in one language and go on in another, pieces show both parts."""
    texts = [say("aa", i, 300) + " " + say("bb", i, 300) for i in range(200)]
    docs = spark.createDataFrame([(i, t, "x", "s", 0) for i, t in enumerate(texts)], DOCS)
    parts = [p.part for p in langid.training_texts(docs, texts=60, piece=200).collect()]
    assert len(parts) == 60 and all(any(p in t for t in texts) for p in parts)
    later = sum("sch" in p or "ung" in p or "pf" in p for p in parts)
    assert 15 < later < 55


def test_all_of_a_long_text_counts(spark):
    judge = langid.Compressors(langid.dictionaries(case(spark)))
    for first, rest in (("aa", "bb"), ("bb", "cc")):
        text = say(first, 1, 40_000)[:100_000] + " " + say(rest, 2, 400_000)[:1_000_000]
        assert judge.judge(text.encode())[0] == rest
    short, long = (judge.judge(say("cc", 3, n).encode()) for n in (6_000, 400_000))
    assert short[0] == long[0] == "cc"
    assert abs(short[1] - long[1]) < 0.05  # the margin does not fade with the length


def test_slices_are_the_whole_text():
    for text in (b"", b"word", b"ab cde " * 5000, b"x" * 10_000, ("añ" * 5000 + " b ").encode() * 3):
        parts = [bytes(p) for p in langid.slices(text)]
        assert b"".join(parts) == text and max(map(len, parts)) <= langid.SLICE


def spelled(text):
    """Words in lower case, apart by one space, by a library of its own."""
    return regex.sub(r"[^\p{L}\p{M}]+", " ", (text or "").lower()).strip()


def test_predictions_equal_plain_compression(spark):
    """Each slice of each text, compressed with each dictionary one after the other."""
    docs = case(spark)
    contents = langid.dictionaries(docs)

    def size(part, content):
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packer = zstandard.ZstdCompressor(
            level=langid.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
        return len(packer.compress(part))

    rows = docs.where("doc_id < 30 OR doc_id > 198 AND length(coalesce(text, '')) < 20000").collect()
    got = {(r.doc_id, r.lang_pred, round(r.score, 9)) for r in langid.identify(docs, contents).collect()}
    for r in rows:
        text = spelled(r.text).encode()
        if not text:
            assert (r.doc_id, "und", 0.0) in got
            continue
        sums = {lang: sum(size(bytes(p), c) for p in langid.slices(text)) for lang, c in contents.items()}
        best, second = sorted(sums.values())[:2]
        lang = min(x for x in sums if sums[x] == best)
        assert (r.doc_id, lang, round(1 - best / second, 9)) in got


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = langid.predict_languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert n > 2000 and right >= 0.98
