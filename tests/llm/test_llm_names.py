"""A user's columns keep their values whatever they are called."""

import pytest
from pyspark.sql import functions as F

from notice_engine.llm import mixing, neardup, quality, substring
from notice_engine.llm.names import apart

#: Names that stages use, or could use, for themselves.
INTERNAL = ["_digest", "digest", "_new", "new", "_first", "first", "_words", "words", "_kept", "kept", "_text", "own", "_own", "_tid", "tid", "_doc", "doc", "_copies", "copies", "_copy", "copy", "_source", "__source", "_repeats", "repeats", "_threshold", "threshold", "_Score", "SCORE", "_stat_log_words", "log_words", "Lines", "_class", "n", "stays", "keeper", "class_id", "h", "size"]


def test_apart():
    assert apart(["a", "_A"], "a", "b", "B") == ["__a", "b", "_B"]


@pytest.fixture(scope="module")
def docs(spark):
    body = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    rows = [(i, body * (1 + i % 2) + f"end {i % 5}", "en", "ab"[i % 2], 10) for i in range(30)] + [(99, None, None, None, None), (98, "", "", "a", 0)]
    plain = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    return plain.select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in INTERNAL])


@pytest.mark.parametrize("stage", ["substrings", "mixing", "near_duplicates", "quality"])
def test_columns_survive(spark, docs, stage):
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    stages = {"substrings": substring.without_repeated_substrings, "mixing": mixing.mixed_documents, "near_duplicates": neardup.without_near_duplicates, "quality": lambda d: quality.kept_documents(d, labels)}
    out = stages[stage](docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in INTERNAL)
