import pytest

from tollbook.llm.common import reachable

#: Columns whose names the operators use inside.
CLASHING = ("_row", "h", "seg", "n", "node", "words", "key", "spans", "kept", "digest", "rows", "vector")


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


@pytest.fixture
def documents(spark):
    """A table of (doc_id, text) pairs, with further columns of awkward names."""

    def make(*rows):
        schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
        return spark.createDataFrame([(*r, *["x"] * len(CLASHING)) for r in rows], schema)

    return make
