import os

import pytest
from llm_cases import ODD_TEXTS


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Odd texts, null ids, repeated rows, and extra columns whose names clash with outputs."""
    rows = [(i, t, "x", -1, True) for i, t in enumerate(ODD_TEXTS)]
    rows += [(None, "no id", "y", 1, False), (None, None, None, None, None), (3, "a", "x", -1, True)]
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, sequence_id long, kept boolean")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, kept string")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver tables are absent")
    return SF
