from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns named like helper columns."""

    def make(rows, more="score double, kept boolean, size long, doc string"):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, 0.5, True, 1, "x") for r in rows]
        return spark.createDataFrame(full, f"{DOCS}, {more}")

    return make
