import pytest


def fold(text):
    """Lower-cases A-Z only."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="session")
def docs(spark):
    """Small documents tables; the extra columns carry names that operators use themselves."""
    def make(rows):
        return spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in rows], "doc_id long, text string, n_words int, blob string, score double")
    return make
