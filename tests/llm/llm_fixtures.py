"""Fixtures of these tests (a module of its own: conftest is the name of the one above)."""

import pytest

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table of (doc_id, text[, source]) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)

    return make
