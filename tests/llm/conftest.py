import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def odd(spark):
    import helpers

    return spark.createDataFrame(helpers.odd_documents(), helpers.DOCS)


@pytest.fixture(scope="module")
def no_docs(spark):
    import helpers

    return spark.createDataFrame([], helpers.DOCS)
