import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"

#: Rows that every operator has to take: nulls, empty and blank texts, repeated ids and rows, columns
#: whose names the operators use, a long text.
ODD = [
    (1, "", "a"), (2, None, None), (None, "one two three", "b"), (3, " \t\n ", "a"), (3, "one two three", "a"),
    (3, "one two three", "a"), (4, "é ß 字 \u0000 x" * 3, None), (5, "word " * 3000, "a"), (6, "x" * 20000, "b"),
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    schema = "doc_id long, text string, source string"
    rows = spark.createDataFrame(ODD, schema)
    for name in ("n_words", "kept", "block", "row", "payload", "host", "fingerprint", "hits", "ids"):
        rows = rows.withColumn(name, F.lit(7))
    return rows


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                                                   T.StructField("source", T.StringType())]))


@pytest.fixture(scope="session")
def texts(documents, odd):
    """(doc_id, text) of the smallest corpus and the odd rows."""
    return documents.select("doc_id", "text").union(odd.select("doc_id", "text")).cache()
