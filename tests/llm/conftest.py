import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, score double, component_id string, _lines string"


@pytest.fixture
def corpus(spark):
    """A table of documents with extra columns whose names clash with results."""
    def make(texts, **columns):
        rows = [(i, t, columns.get("lang", {}).get(i, "en"), columns.get("source", {}).get(i, f"s{i % 3}"), len(t or ""),
                 0.5, "x", "y") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture
def by_id():
    """{doc_id: row} of a result."""
    return lambda df, key="doc_id": {r[key]: r for r in df.collect()}


@pytest.fixture
def nulls(spark, documents):
    """One row in which every column is null."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in documents.schema])
