import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lexiframe.session import local_session

    s = local_session(4, 4, app="lexiframe-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny_docs(spark):
    """Hand corpus: doc 1 `a b a c`, doc 2 `a b`, doc 3 `c c d`, doc 4 `e` (N = 4)."""
    return spark.createDataFrame(
        [(1, "a b a c", "en", "s1"), (2, "a b", "en", "s1"), (3, "c c d", "fr", "s2"), (4, "e", "de", "s2")],
        "doc_id bigint, text string, lang string, source string")


@pytest.fixture(scope="session")
def tiny_index(tiny_docs):
    from lexiframe.operators.index import build_index

    return build_index(tiny_docs)
