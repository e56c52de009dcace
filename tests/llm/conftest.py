import pytest
from pyspark.sql import functions as F

#: Null and empty texts, repeated rows, a null id, ties, and columns whose names clash with helpers.
EDGE = "doc_id long, text string, lang string, source string, n_chars long, score double, _row string, copies int"


@pytest.fixture(scope="session")
def edge_docs(spark):
    long = " ".join(f"word{i % 700}" for i in range(30_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "src1", 0), (3, "   \n\t ", "en", "src1", 3),
        (4, "one two three", "en", "src2", 13), (5, "one two three", "en", "src2", 13), (5, "one two three", "en", "src2", 13),
        (None, "one two three", None, "src2", 13), (6, long, "en", "src3", len(long)), (7, "ÄÖ ü ñ 中文 😀 ▁x  y", "de", None, 5),
        (8, "a b c d e f g h i j k", "fr", "x", 21), (9, "A B C D E F G H I J K", "fr", "x", 21),
    ]
    return spark.createDataFrame([(*r, 1.0, "r", 7) for r in rows], EDGE)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], EDGE)


def by_id(df, *cols):
    return sorted(map(tuple, df.select("doc_id", *cols).collect()), key=str)


__all__ = ["F", "by_id"]
