"""Small documents that hold every awkward case, and helpers to compare with brute force."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tripflow.llm.common import session  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside; as extra columns of an input they must change nothing.
CLASHES = ("score", "lang_pred", "spans", "ids", "h", "n", "row", "node", "_id", "_key", "doc", "text_key", "kept", "_text", "k")


@pytest.fixture(scope="session")
def awkward():
    words = [f"w{k % 97}x{k % 31}" for k in range(30_000)]
    base = " ".join(f"base{k}" for k in range(60))
    rows = [
        (0, base, "en", "s", 1),
        (1, base.replace("base7 ", "other "), "en", "s", 1),
        (1, base.replace("base7 ", "other "), "en", "s", 1),
        (2, None, "en", "s", None),
        (3, "", None, "s", 0),
        (4, " \n\t ", "de", None, 4),
        (5, "one two", "en", "s", 7),
        (6, "One TWO", "en", "s", 7),
        (7, " ".join(words), "en", None, None),
        (8, "%%% 123 ###", "en", "s", 11),
        (None, "a row without an id but with a few words in it", "en", "s", 5),
        (9, "wäre übermäßig ñandú école " * 3, "fr", "s", 9),
        (10, "x" * 5000, "en", "s", 5000),
        (11, base, None, None, None),
    ]
    return rows


@pytest.fixture(scope="session")
def text_spark(spark):
    return session(spark)


@pytest.fixture(scope="session")
def docs(text_spark, awkward):
    return text_spark.createDataFrame(awkward, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("clash").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(text_spark):
    return text_spark.createDataFrame([], SCHEMA)
