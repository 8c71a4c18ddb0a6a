import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402


@pytest.fixture(scope="module")
def rows():
    return brute.awkward_texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """The awkward texts with columns that clash with names used inside the operators."""
    clash = "size long, key int, node string, _pos int, _sig int, _id int, n int, words string, n_removed int, kept int"
    full = [(i, t, "src", 1, 2, "n", 3, 4, 5, 6, "w", 7, 8) for i, t in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, source string, {clash}")


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")
