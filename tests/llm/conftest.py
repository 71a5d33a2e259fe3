import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with the columns the operators clash with."""

    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        full = [
            (i, t, extra.get("lang", "en"), f"s{(i or 0) % 3}", len(t or "")) for i, t in rows
        ]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def small_docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.fixture(scope="session")
def byte_vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("word_bpe_49k.json")
