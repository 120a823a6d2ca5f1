import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def _rows():
    long_text = " ".join(f"word{k % 997}x{k}" for k in range(30_000))
    plain = "The quick brown fox jumps over the lazy dog near the old stone bridge while seven grey geese watch from the bank of the slow river"
    return [
        (1, plain, "en", "a", len(plain)),
        (2, plain, "en", "a", len(plain)),
        (3, None, "en", "a", 0),
        (4, "", None, "b", 0),
        (5, long_text, "en", "b", len(long_text)),
        (6, "  \n\t ", "en", None, 5),
        (7, "ÀÉ ñandú straße 数据 😀 " * 30, "es", None, 100),
        (None, plain + " today", "en", "a", 0),
        (9, plain, "en", "c", len(plain)),
        (9, plain, "en", "c", len(plain)),
        (10, "one two", "de", "c", 7),
        (11, "one two", "de", "c", 7),
    ]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, copies, repeated rows, equal sizes."""
    return _rows()


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
