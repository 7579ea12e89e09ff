import pytest


@pytest.fixture
def texts(spark):
    """Rows of (doc_id, text, source) with extra columns whose names might clash."""

    def make(rows):
        schema = "doc_id long, text string, source string, node long, _doc string, rep long, n_words string"
        full = [(*r, *["src1"] * (3 - len(r)), 7, "x", 8, "y") for r in rows]
        return spark.createDataFrame(full, schema).repartition(3)

    return make
