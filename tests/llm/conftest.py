import pytest

#: Columns whose names the operators use inside; they must not matter.
CLASH = ("id", "n_words", "kept", "place", "mark", "rest", "places", "sig", "label", "size", "key", "bucket", "_id", "_text", "n")


@pytest.fixture(scope="session")
def make_docs(spark):
    """rows of (doc_id, text[, source]) -> documents with extra columns of clashing names."""
    def make(rows, **schema):
        import corpus_pipeline  # noqa: F401  (the pipeline and the operators import without a session)
        from airmart.llm.registry import importable

        importable(spark)
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or ""), *range(len(CLASH))) for r in rows]
        ddl = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASH)
        return spark.createDataFrame(full, ddl)
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    """(doc_id, text) pairs of the small documents table."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return [(r[0], r[1]) for r in rows]
