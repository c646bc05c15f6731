import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (doc_id, text) pairs, with columns of names that operators use too."""

    def build(rows, kind="doc_id long, text string, lang string, score string, kept string, n_lines string, id string, rep string"):
        return spark.createDataFrame([(i, t, "en", "s", "k", "n", "i", "r") for i, t in rows], kind)

    return build
