import os
import sys

import pytest

from llm_helpers import make_docs

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(make_docs(), DOCS).repartition(5)


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def odd(spark):
    """Repeated rows, ids that repeat with other texts, null ids, and columns whose names the operators use."""
    return spark.createDataFrame(
        [(1, "one line of text here\nsame line of text", "a", 1), (1, "one line of text here\nsame line of text", "a", 1),
         (1, "another text under the same id\nsame line of text", "b", 2), (None, "same line of text\nmore", "c", 3),
         (None, None, None, None), (7, "", "c", 4)],
        "doc_id long, text string, __id string, fp long").selectExpr(
        "doc_id", "text", "__id", "fp", "'h' as hash", "1 as pos", "2 as doc", "3 as version", "'s' as source",
        "4 as n_words", "5 as file", "6 as part", "7 as `__doc`", "8 as kept")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
