import pytest
from pyspark.sql import types as T

CLASH = ["spans", "node", "token", "row", "score", "lang", "label", "hash", "key", "sketch", "n", "text_key", "component", "0", "1", "hits", "__id", "__key", "__again", "__bad_id", "__bad_text", "__lang", "__score", "c0", "c1", "nth"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) rows, with columns that clash with
    names used inside the operators."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *(T.StructField(c, T.StringType()) for c in CLASH)])

    def make(rows, parts=3):
        return spark.createDataFrame([(i, t, *["x"] * len(CLASH)) for i, t in rows], schema).repartition(parts)

    return make


LONG = "plain words go on and on without an end " * 4000


@pytest.fixture(scope="session")
def odd_rows():
    """Null keys and texts, empty texts, signs only, a very long text, repeated rows."""
    return [(None, "a text without a key"), (1, None), (2, ""), (3, " \t\n"), (4, "?!... --"), (5, LONG), (6, "same row"), (6, "same row"),
            (7, "ünïcödé 日本語 text 🙂 here"), (8, "one")]
