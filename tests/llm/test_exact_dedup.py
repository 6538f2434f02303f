import hashlib
import random
import re
from collections import Counter

from llm_data import make_docs, prose
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup as dedup


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


TEXTS = [
    "a  b", "a\tb", "a b", " a b", "A b", None, "", " ", "\n", "é é", "é é", prose(1, 200_000), prose(1, 200_000) + "\n",
] + ["hot text"] * 300 + [prose(i % 40) for i in range(120)]


def test_equals_brute_force(spark):
    got = dedup.exact_duplicates(make_docs(spark, TEXTS).repartition(5)).collect()
    groups = {}
    for i, t in enumerate(TEXTS):
        groups.setdefault(digest(t), []).append(i)
    want = [(i, digest(t), min(groups[digest(t)]), len(groups[digest(t)]), i == min(groups[digest(t)]))
            for i, t in enumerate(TEXTS)]
    assert sorted(map(tuple, got)) == want


def test_null_and_repeated_ids(spark):
    docs = make_docs(spark, [(3, "x"), (3, "x"), (3, "y"), (None, "x"), (None, "z"), (None, "z"), (5, "y")])
    got = Counter(tuple(r) for r in dedup.exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept").collect())
    assert got == Counter({
        (3, 3, 3, True): 1, (3, 3, 3, False): 1, (None, 3, 3, False): 1, (3, 3, 2, True): 1, (5, 3, 2, False): 1,
        (None, None, 2, True): 1, (None, None, 2, False): 1})
    kept = dedup.keep_first(docs)
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("3", "x"), ("3", "y"), ("None", "z")]
    assert kept.columns == docs.columns


def test_columns_with_the_names_of_working_columns(spark):
    docs = make_docs(spark, [(3, "x y"), (3, "x  y"), (3, "x y"), (4, "x\ty"), (5, "z")])
    for name in ("__key", "__id", "__mark", "__digest", "__kept", "mark", "digest", "keep_id"):
        docs = docs.withColumn(name, F.lit(name))
    kept = dedup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r["__digest"], r.keep_id) for r in kept.collect()) == [(3, "__digest", "keep_id"), (5, "__digest", "keep_id")]


def test_filter_deletes_and_overflows():
    rnd = random.Random(1)
    f = dedup.CuckooFilter(16)
    held = []
    while True:
        h = rnd.getrandbits(64)
        if not f.insert(h):
            break
        held.append(h)
    assert len(held) > 16 * dedup.SLOTS * 0.8
    f, some = dedup.CuckooFilter(64), held[:40]
    assert all(f.insert(h) for h in some) and all(h in f for h in some)
    for h in some[:20]:
        f.delete(h)
    assert all(h in f for h in some[20:]) and sum(h in f for h in some[:20]) <= 1


def test_shard_follows_a_multiset():
    """Insertions and deletions of live copies, through resizes, against a counter."""
    rnd, shard, live = random.Random(2), dedup.Shard(4), Counter()
    keys = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(3000)]
    for _ in range(20_000):
        key = rnd.choice(keys)
        if live[key] and rnd.random() < 0.4:
            shard.delete(key, 1)
            live[key] -= 1
        else:
            shard.insert(key, rnd.randrange(100), 1)
            live[key] += 1
    assert {k: n for k, _, n in shard.keys()} == {k: n for k, n in live.items() if n > 0}
    assert shard.resizes > 3
    assert all((shard._verified(shard._hash(k), k) is not None) == (live[k] > 0) for k in keys)


def test_false_positives_do_not_merge():
    shard = dedup.Shard(4)
    same_hash = [d + "ab" * 8 + d + d for d in ("0" * 16, "1" * 16)]
    for d in same_hash:
        shard.insert(d, 1, 1)
    assert sorted(k for k, *_ in shard.keys()) == sorted(same_hash)
    shard.delete(same_hash[0], 1)
    assert [k for k, *_ in shard.keys()] == [same_hash[1]]


def test_index_takes_insertions_and_deletions(spark):
    rows = dedup.digests(make_docs(spark, ["a", "b", "b", "c"]))
    index = dedup.build_index(rows, 4)
    more = dedup.digests(make_docs(spark, ["c", "d"], first=10))
    gone = dedup.digests(make_docs(spark, [(0, "a"), (1, "b"), (99, "never there")]))
    left = dedup.digests(make_docs(spark, [(2, "b"), (3, "c"), (10, "c"), (11, "d")]))
    after = dedup.update_index(index, 16, more, gone, left)
    got = {r.digest: (r.keep_id, r.live) for r in after.collect()}
    assert got == {digest("b"): (2, 1), digest("c"): (3, 2), digest("d"): (11, 1)}


def test_large_ids_beside_a_null_id(spark):
    """Ids above 2^53 stay exact in a batch that holds a null id."""
    big = 2**53 + 1
    docs = make_docs(spark, [(big, "x"), (big + 2, "x"), (None, "y"), (big + 4, "z")]).coalesce(1)
    got = {r.doc_id: (r.keep_id, r.kept) for r in dedup.exact_duplicates(docs).where("doc_id IS NOT NULL").collect()}
    assert got == {big: (big, True), big + 2: (big, False), big + 4: (big + 4, True)}
