import re

import pytest
from llm_data import changed, make_docs, prose, rows_of
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as dec

ITEMS = "item_id long, text string, doc_id long"


def brute(docs, items, share=0.8):
    def grams(text):
        w = re.findall(r"[^\W_]+", (text or "").lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    out = []
    for d, text in docs:
        have = grams(text)
        for i, item in items:
            want = grams(item)
            if want and len(want & have) >= share * len(want) - 1e-9:
                out.append((d, i, len(want & have), len(want)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def case():
    items = [(k, prose(100 + k, 8 + 7 * k, 900)) for k in range(12)] + [(50, "too few words"), (51, None), (52, "")]
    docs = [(0, prose(1, 3000)), (1, None), (2, ""), (3, "too few words")]
    for k in range(12):
        item = items[k][1]
        n = len(item.split())
        docs.append((10 + k, prose(k, 400) + "\n" + item.upper().replace(" ", ",  ") + "\n" + prose(k + 50, 2000)))
        docs.append((30 + k, prose(k, 40) + " " + changed(item, max(1, n // 40), k) + " " + prose(k + 9, 40)))
        docs.append((60 + k, prose(k, 40) + " " + changed(item, max(2, n // 4), k)))
        docs.append((90 + k, " ".join(item.split()[: n // 2])))
    return docs + [(10, docs[4][1]), (None, items[3][1])], items


def test_equals_brute_force(spark, case):
    docs, items = case
    table = spark.createDataFrame([(*i, 1) for i in items], ITEMS)  # an extra column that documents have too
    got = dec.contaminated(make_docs(spark, docs), table)
    want = brute(docs, items)
    assert rows_of(got, "doc_id", "item_id", "shared", "total") == want
    assert len(want) > 20


@pytest.mark.parametrize("share", [0.5, 0.65, 0.95, 1.0])
def test_other_shares(spark, case, share):
    docs, items = case
    table = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    got = dec.contaminated(make_docs(spark, docs), table, share)
    assert rows_of(got, "doc_id", "item_id", "shared", "total") == brute(docs, items, share)


def test_only_documents_with_an_item_go(spark, case):
    docs, items = case
    table = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    kept = dec.without_benchmark(make_docs(spark, docs), table)
    bad = {d for d, *_ in brute(docs, items)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in bad)
    assert kept.columns == make_docs(spark, docs).columns


def test_an_item_id_on_two_texts(spark):
    """A document with all of the short text and a part of the long one is found by the short one."""
    short, long = prose(1, 8, 900), prose(2, 400, 900)
    docs = [(1, prose(3, 100) + " " + short + " " + " ".join(long.split()[:60])), (2, prose(4, 100)), (None, long)]
    items = [(7, short), (7, long), (None, short)]
    table = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    got = dec.contaminated(make_docs(spark, docs), table)
    assert rows_of(got, "doc_id", "item_id", "shared", "total") == brute(docs, items)
    assert [r.doc_id for r in dec.without_benchmark(make_docs(spark, docs), table).collect()] == [2]


def test_an_id_on_two_documents(spark):
    """Only the text with the item goes, though both have one id, and names of working columns stay."""
    item = prose(1, 40, 900)
    docs = make_docs(spark, [(1, prose(2) + " " + item), (1, prose(2)), (None, item), (None, prose(5))])
    for name in ("__key", "__id", "__mark", "mark", "item_id", "hash", "need"):
        docs = docs.withColumn(name, F.lit(name))
    kept = dec.without_benchmark(docs, spark.createDataFrame([(9, item, 1)], ITEMS))
    assert kept.columns == docs.columns
    assert rows_of(kept, "doc_id", "text", "__key", "hash") == sorted(
        [(1, prose(2), "__key", "hash"), (None, prose(5), "__key", "hash")], key=repr)


def test_a_very_long_text(spark):
    item = prose(1, 30, 900)
    text = prose(2, 150_000) + " " + item + " " + prose(3, 150_000)
    table = spark.createDataFrame([(9, item, 1)], ITEMS)
    assert rows_of(dec.contaminated(make_docs(spark, [text, prose(4)]), table), "doc_id", "item_id") == [(0, 9)]


def test_plan_has_no_python(spark, case):
    docs, items = case
    rows = make_docs(spark, docs).selectExpr("doc_id", "text")
    plan = dec.sketch(rows.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEval" not in plan and "Pandas" not in plan and "MapIn" not in plan
