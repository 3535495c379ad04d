import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).parent))

from conftest_llm import prose  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
BLANK = " \t\n\x0b\f\r"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text[, source]) rows."""

    def make(*rows):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, COLUMNS)

    return make


@pytest.fixture
def odd(documents):
    """Nulls, empty and blank texts, repeated rows, an id with two texts, very long texts."""
    return documents(
        (1, "alpha beta  gamma"),
        (2, "alpha beta gamma"),
        (2, "alpha beta gamma"),
        (3, None),
        (4, ""),
        (5, BLANK),
        (None, "alpha beta gamma"),
        (None, prose(50)),
        (6, prose(60_000)),
        (7, prose(60_000)),
        (8, "x" * 200_000),
        (2, "another text " * 9),
        (9, "Zoë's 12 naïve – 漢字 🙂\r\n"),
    )


@pytest.fixture
def clashing(odd):
    """The same rows with further columns under names that operators use for themselves."""
    from pyspark.sql import functions as F

    names = ["_text", "_key", "_row", "fp", "size", "slot", "at", "_id", "target", "part", "_range", "ids", "_size", "kept"]
    return odd.withColumns({n: F.lit(f"extra {n}") for n in names})
