import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture
def texts_frame(spark):
    """documents-like rows (doc_id, text), with extra columns whose names the operators use themselves."""

    def make(rows):
        schema = "doc_id long, text string, lang string, source string, n_chars long, u long, size string, component array<int>"
        return spark.createDataFrame(
            [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t), 1, "x", None) for i, t in rows], schema
        )

    return make
