import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, key string, h bigint, spans string, id bigint"


@pytest.fixture(scope="session")
def rows_of(spark):
    """Documents with extra columns that clash with names the operators use inside."""
    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", 1, "z", 9) for i, t in pairs], SCHEMA)

    return make


ODD_ROWS = [(1, None), (2, ""), (3, "   \n\t"), (4, "one"), (5, "a b c"), (5, "a b c"), (None, "no id here at all"), (7, "word " * 30000), (8, "é▁日本 \x00 ok 😀")]


@pytest.fixture(scope="session")
def odd(rows_of):
    return rows_of(ODD_ROWS)


@pytest.fixture(scope="session")
def empty(rows_of):
    return rows_of([])
