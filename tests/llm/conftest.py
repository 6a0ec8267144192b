"""Small document tables with the odd cases that every operator must take."""

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use inside.
CLASHING = ("row", "node", "shard", "kept", "one", "n_words", "fp", "digest", "level", "bucket", "_row", "_text", "spans")


@pytest.fixture
def table(spark):
    """Rows of (doc_id, text) as a documents table; ``clashing`` adds columns."""

    def make(rows, clashing=False):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(rows, SCHEMA)
        if clashing:
            from pyspark.sql import functions as F

            df = df.select(*[F.lit(None if k % 2 else "x").alias(c) for k, c in enumerate(CLASHING)], *df.columns)
        return df.repartition(3)

    return make


@pytest.fixture
def odd_rows():
    """Nulls in id and text, empty and blank texts, repeated rows, a very long text."""
    long = " ".join(f"w{k % 997}é" for k in range(30000))
    return [(1, "a b  c"), (2, "ab\tc"), (3, None), (4, ""), (5, " \n\t"), (None, "abc"), (None, None), (7, "abc"),
            (7, "abc"), (8, long), (9, long + " "), (10, "x" * 70000), (11, "<|endoftext|> ▁ \x00 é 😀")]
