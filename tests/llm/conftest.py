import pytest

import pyspark.sql.types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    *[T.StructField(n, T.StringType()) for n in ("key", "keep", "_fp", "_text", "_key", "_row", "shard", "ids", "tkey", "rank")],
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts, or (doc_id, text) pairs, with columns of clashing names."""

    def make(texts, lang="en"):
        rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, lang, "src", None if t is None else len(t), *["x"] * 10) for i, t in rows], DOC)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, repeated rows, a shared id."""
    long_ = " ".join(f"word{i % 977} tail{i % 13}" for i in range(30_000))
    return make_docs([None, "", "   \n\t", "One two three.", (3, "One two three."), (3, "One two three."), (None, "four five"), long_, long_ + " x", "é" * 500, "a"])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
