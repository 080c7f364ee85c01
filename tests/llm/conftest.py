from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    """The whole table, as Spark and as rows."""
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return df, df.collect()


@pytest.fixture
def odd_texts(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names that operators use."""
    texts = [
        None, "", " \n\t", "word", "the same words again " * 3, "the same words again " * 3, "é ß 日本語 ﬁ   İ",
        "x" * 3000, "long words here and there " * 4000, "#$%& 12 {} <b>", "a\x00b\x1cc",
    ]
    rows = [(i, text, "en" if i % 2 else None, None if i == 3 else "s", -1, "clash") for i, text in enumerate(texts)]
    rows += [rows[4], (None, "no id at all", "en", "s", -1, "clash")]
    schema = "doc_id long, text string, lang string, source string, kept int, row string"
    return spark.createDataFrame(rows, schema).repartition(3)
