import pytest
from pyspark.sql import functions as F

from tests.conftest import SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


#: id, text: nulls, empty and blank texts, one word, repeated rows, ties, odd characters, a long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "word"), (5, "a b c d e f g h i j k l m n o p"), (5, "a b c d e f g h i j k l m n o p"), (5, "another text of the same id"),
    (None, "a b c d e f g h i j k l m n o p"), (None, None), (None, "null id alone"), (6, "a  b\tc d\ne f g h i j k l m n o p "), (7, "\u00e9t\u00e9 \u4e2d\u6587 \U0001f600 \x85\xa0x  y \x1c z"),
    (8, "lorem ipsum dolor sit amet " * 4000), (9, "x" * 50_000), (10, " " * 3000 + "\n" * 3000), (11, "password = Tr0ub4dor&3xyzzy99 and token: abcdefghijkl0123"),
]

CLASHING = ["digest", "keep_id", "keep_rows", "fp", "root", "component_id", "row", "h", "word", "n", "s", "piece", "length", "kept", "score", "count",
            "__keep", "__heavy", "__n", "__root", "__digest", "__fp", "__text", "__shard", "c0", "c1"]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with columns whose names clash with the operators' own."""
    df = spark.createDataFrame([(i, t, "en", "src0", None if t is None else len(t)) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(c) for c in CLASHING}).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
