import pytest

#: Extra columns with names that the operators use for their own.
CLASHING = "bucket long, keep_id string, kept int, score string, component_id string, piece string, range int, label string, bands string, next_text string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with extra columns of clashing names, some of them null."""
    def make(pairs, parts=3):
        n = len(CLASHING.split(","))
        rows = [(i, t, "en" if k % 2 else None, f"src{k % 3}", None, *[None] * n) for k, (i, t) in enumerate(pairs)]
        df = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")
        return df.repartition(parts) if rows else df
    return make


@pytest.fixture(scope="session")
def written(docs_of, tmp_path_factory):
    """A folder with documents and labels, as a query wants it."""
    def make(pairs, labels=()):
        path = str(tmp_path_factory.mktemp("tables"))
        df = docs_of(pairs)
        df.write.parquet(f"{path}/documents.parquet")
        df.sparkSession.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        return path
    return make


@pytest.fixture(scope="session")
def real():
    """Ids and whole texts of the smallest generated table."""
    import pyarrow.parquet as pq
    read = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    return list(zip(read["doc_id"].to_pylist(), read["text"].to_pylist()))
