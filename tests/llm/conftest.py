import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and
    columns whose names the operators use themselves."""
    rng = random.Random(7)
    long_text = " ".join(rng.choice(["alpha", "Beta", "γάμμα", "delta,", "x1"]) for _ in range(30_000))
    texts = [(0, "one two three four five"), (1, "one two three four five"), (1, "one two three four five"),
             (2, None), (3, ""), (4, " \n\t "), (None, "a text without id"), (5, long_text),
             (6, "word"), (7, "naïve café 中文 😀   end\n\n"), (None, None), (8, "x" * 5000),
             (9, "for " * 3000)]
    rows = [(i, t, None if i == 6 else "en", f"src{k % 3}", len(t or ""), k, k, "fp", "k")
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + ", start long, spans long, fp string, key string")


@pytest.fixture(scope="session")
def no_documents(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}
