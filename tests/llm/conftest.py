import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and extra columns with names used inside."""
    long = "word " * 30_000 + "a.b@c.de " + "x" * 50_000
    rows = [
        (1, "Hello there general public license, CC BY, all rights reserved. mail me@x.org now", "en", "s", 5),
        (2, None, None, None, None), (3, "", "en", "s", 0), (None, "orphan text with a few words", "en", None, 1), (4, long, "en", "s", len(long)),
        (5, "same words here for two rows", "en", "s", 1), (5, "same words here for two rows", "en", "s", 1), (5, "another text under that id", "en", "s", 1), (6, "same words here for two rows", "fr", "t", 1),
        (7, " \t\n\r ", "en", "s", 1), (8, "é😀 ünï — 中文字符  x", "zh", "s", 1), (None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "1 as id", "2 as root", "3 as tid", "4 as band", "5 as shard", "6 as h", "7 as base", "8 as words", "9 as grp", "10 as salt", "11 as ids", "12 as n_tokens", "13 as __key", "14 as bucket", "15 as kept2")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}
