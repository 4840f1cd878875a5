import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
VECS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


@pytest.fixture
def documents(spark):
    """A table of documents from texts, or from (id, text) pairs; languages alternate."""

    def make(texts, lang=None):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [Row(doc_id=i, text=t, lang=lang[k] if lang else ("en", "fr")[k % 2], source=f"s{k % 3}", n_chars=len(t or "")) for k, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, DOCS) if rows else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0) for i, v in rows], VECS)
