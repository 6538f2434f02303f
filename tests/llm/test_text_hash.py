import pyarrow as pa
from llm_data import prose

from tidemark.llm import text_hash


def words(*texts, **more):
    return [
        [bytes(w.data[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])]
        for w in text_hash.word_slices(pa.array(texts, pa.string()), **more)
        for a, b in zip(w.first[:-1], w.first[1:])
    ]


def test_words_by_white_space():
    assert words("a b\tc\n\nd", None, "", "  x ", "éa b") == [list("abcd"), [], [], ["x"], ["éa", "b"]]
    assert words("CC BY-NC 4.0!", lower=True, blank=text_hash.PUNCTUATION)[0][0] in ("CC", "cc")


def test_slices_hold_whole_texts():
    texts = [prose(i, 3000) for i in range(120)] + ["", prose(1, 700_000)]
    assert words(*texts) == [t.split() for t in texts]


def test_grams_are_those_of_words():
    texts = ["a b c d e f", "a  b c d e", "b c d e f", "a b c", "a b c", "x", "", "a b c d e f a b c d e f"]
    (w,) = text_hash.word_slices(pa.array(texts))
    sets = [set(s.tolist()) for s in text_hash.gram_sets(w, 5)]
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 1, 0, 6]
    assert sets[0] == sets[1] | sets[2] and sets[3] == sets[4] != sets[5]
    assert sets[0] < sets[7]


def test_hashes_do_not_depend_on_the_place():
    (a,) = text_hash.word_slices(pa.array(["one two three", "zzz one two three"]))
    assert a.hash[:3].tolist() == a.hash[4:].tolist()
    assert len(set(a.hash.tolist())) == 4
