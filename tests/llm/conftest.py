import re

import duckdb
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Rows that every operator must take: nothing, white space, short, long, repeated, odd characters.
EDGES = [
    (900001, None, None, None), (900002, "", "en", "src0"), (900003, " \n\t ", "en", None), (900004, "one", "en", "src1"),
    (900005, "Tie tie TIE\n\ntie", "de", "src1"), (900006, "a  b\t\tc \n d\r\n\r\nend ", "xx", ""),
    (900007, "<|endoftext|> it's </s>[INST] \\ back", "en", "src2"), (900008, "ÀÉ ΣΑΣ 漢字 é  x", "fr", "src2"),
    (900009, "word " * 30_000, "en", "src3"), (900010, "same line of seven words here now\n" * 3, "en", "src3"),
    (900011, "same line of seven words here now", "en", "src3"), (900011, "same line of seven words here now", "en", "src3"),
    (900012, "x" * 50_000, "en", "src4"),
]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


@pytest.fixture(scope="session")
def corpus():
    """Rows of the smallest documents table and the edge rows."""
    rows = duckdb.connect().execute(f"SELECT doc_id, text, lang, source FROM '{SF}/documents.parquet'").fetchall()
    return rows + EDGES


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with columns whose names clash with those the operators use inside."""
    df = spark.createDataFrame(corpus, "doc_id BIGINT, text STRING, lang STRING, source STRING").repartition(3)
    return df.select("*", F.length("text").cast("long").alias("n_chars"), *[
        F.lit(1).alias(c) for c in ("row", "size", "n", "key", "doc", "kept", "block", "held", "a b")
    ]).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)
