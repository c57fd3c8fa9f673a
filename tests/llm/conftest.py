import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The smallest driver table, and its (doc_id, text) rows."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    return df, [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    from tidemark.llm.tokens import vocabulary_path
    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    return t


LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGE_DOCS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "One"), (5, "a b c d e a b c d e"), (6, LONG), (7, LONG),
    (8, "ñ é # 日本 * |\n" + "w " * 9), (None, "no id here, but words enough for a rule or two\nand lines\nmore"),
    (9, "x\n\ny\n\nx\n\ny\n"), (10, "<|endoftext|> and   runs of   space \r\n\r\n end  "), (10, "other text, same id"),
    (11, "MIT License. mit license; the General Public License"), (12, "tie tie tie tie"), (12, "tie tie tie tie")]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties and repeated rows, and columns whose names operators use."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE_DOCS, "doc_id long, text string")
    return df.select("*", F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"),
                     F.length("text").cast("long").alias("n_chars"),
                     *[F.lit(1).alias(c) for c in ("row", "rk", "fp", "key", "words", "bucket", "spans", "n_words",
                                                   "items", "lines", "part", "host", "section", "h")]), EDGE_DOCS


@pytest.fixture(scope="session")
def empty(edge):
    return edge[0].limit(0)
