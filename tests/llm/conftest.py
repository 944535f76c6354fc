import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

EXTRA = ["ids", "size", "row", "quality", "spans", "class", "keys", "n_words", "lang_pred", "template", "length", "_row", "_quality", "_copy"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)
PLAIN = " ".join(f"word{i} of plain prose" for i in range(30))
ROWS = [
    (1, PLAIN, "en", "a"), (1, PLAIN, "en", "a"), (2, PLAIN, None, "a"), (3, None, "en", None), (4, "", None, None), (5, " \t\n\x0b ", "en", "a"),
    (6, "one two three", "en", "b"), (7, "one two three", "de", "b"), (None, "nobody knows me " * 10, "en", "b"),
    (8, "mail jo.doe@mail.example.com or +1 (755) 555-9729 from 10.0.0.1 " + PLAIN, "en", "b"),
    (9, "%%% *** ### " * 40, "en", "b"), (10, "again " * 4000, "de", "c"), (11, "é日本語🎉 " * 30 + PLAIN[:80], "de", "c"), (12, "x" * 50_000, "de", "c"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names operators use themselves."""
    rows = [(i, text, lang, source, len(text or ""), *["extra"] * len(EXTRA)) for i, text, lang, source in ROWS]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
