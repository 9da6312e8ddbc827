"""Helpers of the operators' tests: small frames with odd rows, and scratch folders that go with the test."""

import pytest

from catalog_sync.llm.tables import Scratch

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls in every column, empty and blank texts, repeated rows, control characters and other scripts.
ODD_TEXTS = [None, "", " \t\n\x0b\x0c\r", "one", "One two", "a b c d e f g", "A B C D E F G", "x  y\n\nz", "näïve ÜBER 日本語 ҈     end",
             "l1 a b\nl1 a b\n\nl2\nl1 a b", "to be or not to be that is to be or not to be that"]


@pytest.fixture
def scratch(spark):
    before = list(Scratch.live)
    yield Scratch(spark, "test")
    for s in [s for s in Scratch.live if s not in before]:
        s.release()


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["s0", None, "s1"][i % 3], None if t is None else len(t)) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[5], rows[5], (None, "no id", "en", "s0", 5), (None, None, None, None, None), (77, "word " * 40_000, "en", "s0", 200_000)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
