import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, words=60, vocabulary=400):
    rnd = random.Random(seed)
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(words))


def changed(text, count, seed=0):
    """The text with some words exchanged."""
    rnd, parts = random.Random(seed), text.split()
    for i in rnd.sample(range(len(parts)), count):
        parts[i] = f"new{rnd.randrange(10**6)}"
    return " ".join(parts)


def make_docs(spark, texts, first=0):
    """Documents with rising ids; a pair is (id, text)."""
    pairs = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en", f"src{i % 3}" if i else None, len(t or "")) for i, t in pairs]
    return spark.createDataFrame(rows, DOCS)


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
