import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents from (doc_id, text) pairs, with extra columns whose names clash."""

    def make(rows, parts=3):
        schema = "doc_id long, text string, lang string, source string, n_chars long, rank long, part int, tie long, start long"
        full = [(i, t, "en", "s", len(t or ""), 7, 7, 7, 7) for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(parts) if full else spark.createDataFrame([], schema)

    return make
