import pytest

LONG = "the quick brown fox jumps over the lazy dog and runs far away from here "


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents with an extra column whose name clashes with a result's."""
    from rillmart.llm.frames import ready

    def make(rows):
        ready(spark)
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or ""), "x", "y") for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, score string, __row string")
    return make


ODD = [(1, None), (2, ""), (None, "a b c d"), (None, None), (3, "a b c d"), (3, "a b c d"), (4, " \t\n"), (5, "A B c D " * 4000), (6, "é　x\x1cy 日本語")]


@pytest.fixture
def odd():
    return ODD
