"""Small tables with every odd case: nulls, empty and very long texts, ties, repeated rows."""

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 8000 + "x" * 5000
#: Names that the operators use inside or return.
CLASHES = ("epochs", "budget", "last", "row", "_row", "fp", "size", "target", "_base", "_all", "ids_", "text_", "paths",
           "_host", "_lang", "_limit", "_keep", "_ppl", "_chunk", "_id", "_key", "_source", "g", "c", "root", "label")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with the odd cases and columns of clashing names."""
    plain = "the quick brown fox jumps over the lazy dog while the cat looks on from the wall " * 5
    rows = [
        (1, plain, "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (4, LONG, "en", None), (5, plain, "en", "a"),
        (6, plain + "again", "en", "c"), (6, plain + "again", "en", "c"), (7, " \t\n ", "fr", "b"),
        (8, "mail a.b@c.example or +1 (614) 555-8001 from 10.0.0.1, card 4111 1111 1111 1111", "en", "b"),
        (None, plain, None, None), (None, "no id here", "de", "d"), (9, "ÄÖÜ ß 日本語 🎉 ▁ \u0000", "de", "d"),
        (9, "same id, other text", "de", "d")]
    df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], SCHEMA)
    return df.withColumns({c: F.lit(f"keep {c}") for c in CLASHES})


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 1, None), (5, None, 1), (6, 0, 1), (None, 1, 1), (77, 1, 1), (8, 1, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
