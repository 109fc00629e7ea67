import pytest

from stratum.llm.common import reach_workers


@pytest.fixture(autouse=True)
def workers(spark):
    reach_workers(spark)


@pytest.fixture()
def docs(spark):
    """Frames of (doc_id, text) with a clashing extra column of each kind."""

    def make(rows, extra=True):
        schema = "doc_id long, text string" + (", id string, label string, n_words string, word string" if extra else "")
        return spark.createDataFrame([(*r, *("x",) * 4 * extra) for r in rows], schema)

    return make
