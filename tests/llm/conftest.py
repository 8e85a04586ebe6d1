import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with nulls, empty and long texts, repeats, and columns whose names clash with the operators' own."""

    def make(texts, **extra):
        rows = [(i, t, *(v[i] for v in extra.values())) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string" + "".join(f", {k} string" for k in extra))

    return make
