import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
# Names that the operators use inside; documents may have them too.
CLASHING = ["rank", "key", "size", "score", "shard", "sketch", "length", "times", "class_id", "word", "row", "first"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, clashing names."""
    long_text = " ".join(f"w{i % 701}x{i}" for i in range(30_000))
    near = " ".join(f"n{i}" for i in range(60))
    rows = [
        (1, "the cat sat on the mat and the dog ran", "en", "s", 38), (2, None, "en", "s", None), (3, "", None, None, 0),
        (4, " \t\n ", "en", "s", 4), (5, "the cat sat on the mat and the dog ran", "de", None, 38), (6, "é中😀 ñ", "fr", "s", 6),
        (7, long_text, "en", "s", len(long_text)), (8, near, "en", "s", len(near)), (9, near.replace("n30", "zz"), "en", "s", len(near)),
        (9, near.replace("n30", "zz"), "en", "s", len(near)), (None, "no id here", "en", "s", 10), (11, "x", "en", "s", 1),
        (12, "<|endoftext|> a <|endoftext|>", "en", "s", 29), (12, "another text of the same id", "en", "s", 27),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return frame.select("*", *[F.lit("clash").alias(name) for name in CLASHING]).repartition(3)


@pytest.fixture(scope="session")
def texts(odd):
    """The rows of ``odd`` as ``(doc_id, text or empty)``."""
    return [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def given(spark):
    """The smallest given documents as a list, too."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
