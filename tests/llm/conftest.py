"""Fixtures of the text operators' tests: small frames with awkward rows."""

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sitelens.session import SESSION_CONF, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[4]").appName("llm-tests")
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    session = builder.config("spark.sql.shuffle.partitions", "4").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session, tempfile.mkdtemp(prefix="llm-ckpt-"))
    yield session


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(rows, schema="doc_id long, text string"):
        from pyspark.sql import functions as F

        return spark.createDataFrame(rows, schema).repartition(3).withColumns(
            {c: F.lit("own") for c in ("n", "size", "bucket", "pos", "a", "b", "sid", "key", "word", "line", "leaf", "recipe", "chunk")})

    return make


#: Null, empty, blank, one word, repeated rows, equal texts, a null id, long and non-ASCII texts.
AWKWARD = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c d e f g"), (5, "a b c d e f g"), (6, "a b c d e f g"),
           (None, "a b c d e f g"), (None, None), (7, "Zażółć gęślą jaźń 𝄞 日本語 " * 40), (8, "x" * 5000), (9, "word " * 3000),
           (10, "line one 1\nline two 2\n\nline one 1")]
