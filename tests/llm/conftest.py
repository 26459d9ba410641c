from __future__ import annotations

import pytest

# Names that the operators use inside; a caller's columns may have them.
CLASHING = "key string, id string, row string, words string, digest string, n long, found string"


@pytest.fixture
def documents(spark):
    """Documents out of (doc_id, text), with columns that clash with the operators' own."""

    def make(*rows):
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        return spark.createDataFrame(
            [(i, t, None, "s", len(t or ""), *["x"] * 5, 1, "x") for i, t in rows], schema
        )

    return make
