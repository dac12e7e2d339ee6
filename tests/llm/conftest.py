import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture
def docs_of(spark):
    """A table of documents from (id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([tuple(r) for r in rows], DOC)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
