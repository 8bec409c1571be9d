import re

import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCUMENTS = "doc_id long, text string, lang string, key string, node int, words string, n long"


@pytest.fixture(scope="session")
def given(spark, sf_dir):
    """The small documents table, and its rows as pairs."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").cache()
    return df, sorted((r.doc_id, r.text or "") for r in df.collect())


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties and repeated rows, under columns with clashing names."""
    long = " ".join(f"word{i}" for i in range(30_000))
    passage = " ".join(f"shared{i}" for i in range(60))
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, passage), (5, passage), (6, "x " + passage + " y"), (None, passage),
        (None, None), (7, long), (8, long + " end"), (9, "same line of words here\nsame line of words here"), (10, "a a a a " * 40),
    ]
    rows = [(i, t, "en", "k", 1, "w", 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where(F.lit(False))
