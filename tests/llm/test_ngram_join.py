from collections import Counter

import numpy as np
import pytest
from llm_data import changed, make_docs, prose, rows_of
from pyspark.sql import functions as F

from tidemark.llm import ngram_join as join


def brute(texts, similar=0.8):
    """Class and number of links of every text, from all pairs."""
    def grams(text):
        w = (text or "").split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else {()}

    sets = [grams(t) for t in texts]
    links = [[j for j in range(len(sets)) if j != i and len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j])]
             for i in range(len(sets))]
    out = []
    for i in range(len(sets)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((i, min(seen), len(links[i])))
    return out


def family():
    base = prose(1, 200)
    near = [changed(base, k % 4, seed=k) for k in range(40)]
    texts = [prose(i, 80) for i in range(10, 30)] + near + [base, base, None, "", " \n", "a b", "a  b", "a c", prose(3, 5)]
    return texts + [prose(77, 30) + " " + base[:200], prose(78, 3000), changed(prose(78, 3000), 20)]


@pytest.mark.parametrize("chunk", [1024, 7])
def test_equals_brute_force(spark, chunk):
    texts = family()
    got = join.similar_documents(make_docs(spark, texts), chunk=chunk)
    assert rows_of(got) == sorted(brute(texts), key=repr)


def test_one_of_each_group_stays(spark):
    texts = family()
    stays = {c for _, c, _ in brute(texts)}
    kept = join.one_of_each(make_docs(spark, texts))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r.doc_id for r in kept.collect()} == stays


def test_null_and_repeated_ids(spark):
    text = prose(1)
    docs = make_docs(spark, [(None, text), (4, text), (4, text), (None, prose(2)), (9, changed(text, 1))])
    got = Counter(rows_of(join.similar_documents(docs)))
    assert got == Counter({(None, 4, 3): 1, (4, 4, 3): 2, (None, None, 0): 1, (9, 4, 3): 1})


def test_an_id_on_two_texts(spark):
    """Rows count by their own text: an unrelated text under the id of a near copy stays."""
    a, other = prose(1), prose(2)
    docs = make_docs(spark, [(1, a), (5, changed(a, 1)), (5, other)])
    assert Counter(rows_of(join.similar_documents(docs))) == Counter({(1, 1, 1): 1, (5, 1, 1): 1, (5, 5, 0): 1})
    assert sorted((r.doc_id, r.text) for r in join.one_of_each(docs).collect()) == [(1, a), (5, other)]


def test_near_copies_without_ids(spark):
    a = prose(1)
    docs = make_docs(spark, [(None, a), (None, changed(a, 1)), (None, prose(2)), (None, a), (7, prose(3)), (7, prose(3))])
    got = Counter(rows_of(join.similar_documents(docs)))
    assert got == Counter({(None, None, 2): 3, (None, None, 0): 1, (7, 7, 1): 2})
    kept = [r.text for r in join.one_of_each(docs).collect()]
    assert len(kept) == 3 and len(set(kept) & {a, changed(a, 1)}) == 1 and {prose(2), prose(3)} <= set(kept)


def test_columns_with_the_names_of_working_columns(spark):
    docs = make_docs(spark, [prose(1), changed(prose(1), 1), prose(2)])
    for name in ("__key", "__same", "__hash", "lead", "node", "key", "text_hash", "grams", "h1", "weight"):
        docs = docs.withColumn(name, F.lit(name))
    kept = join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.node, r["__key"]) for r in kept.collect()) == [(0, "node", "__key"), (2, "node", "__key")]


def neighbours(n, words=120, step=12):
    """Texts of a running window over one long text: each is like the next one only."""
    long = prose(5, words + step * n, 10**6).split()
    return [" ".join(long[k * step:k * step + words]) for k in range(n)]


def test_a_long_chain_is_one_component(spark):
    got = join.similar_documents(make_docs(spark, neighbours(1500)), chunk=256)
    rows = got.collect()
    assert {r.class_id for r in rows} == {0}
    assert Counter(r.n_links for r in rows) == Counter({2: 1498, 1: 2})


def test_pairs_just_above_the_threshold_are_all_found(spark):
    """With s shingles shared of s + d in both, the similarity lies between 0.80 and 0.82."""
    texts = []
    for k in range(10_000):
        words = prose(10_000 + k, 104, 10**9).split()
        texts += [" ".join(words), " ".join(words[:-11] + [f"x{k}y{i}" for i in range(11)])]
    rows = join.similar_documents(make_docs(spark, texts)).collect()
    grams = 100
    assert 0.8 <= (grams - 11) / (grams + 11) < 0.82
    assert sum(r.n_links for r in rows) == len(texts)


def test_a_very_long_text(spark):
    words = prose(4, 200_000, 10**6).split()
    texts = [" ".join(words), " ".join(words[:199_000] + ["z"] * 1000), prose(1)]
    assert rows_of(join.similar_documents(make_docs(spark, texts))) == [(0, 0, 1), (1, 0, 1), (2, 2, 0)]


def test_posterior_bound_is_that_of_the_uniform_prior():
    t, grid = 0.8, np.linspace(0, 1, 200_001)
    for n in (25, 100, 200):
        m = join.least_matches(n, t, 1e-6)

        def reaches(m):
            density = grid**m * (1 - grid) ** (n - m)
            return density[grid >= t].sum() / density.sum()

        assert reaches(m) >= 1e-6 > reaches(m - 1)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:900], rng.integers(0, 2**63, 100).astype(np.uint64)])
    assert abs((join.signature(a) == join.signature(b)).mean() - 900 / 1100) < 0.1
