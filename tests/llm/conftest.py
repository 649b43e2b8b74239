from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])
#: Names that operators might use themselves.
CLASHING = ("fp", "key", "component_id", "i", "t", "n", "digest", "size", "score", "_id", "repeats", "hits", "kept", "node", "tag", "part")


@pytest.fixture(scope="session")
def frame(spark):
    """A documents frame from ``(doc_id, text, lang, source)`` rows, with columns of clashing names."""
    from pyspark.sql import functions as F

    def make(rows):
        padded = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return spark.createDataFrame(padded, DOC).withColumns({c: F.lit("x") for c in CLASHING}).repartition(3)

    return make


@pytest.fixture(scope="session")
def odd(frame):
    """Null ids and texts, empty and very long texts, ties and repeated rows."""
    rows = [(1, None, "en", None), (2, "", None, "a"), (3, " \n\t", "en", "a"), (None, "a b c d", None, "b"), (5, "one", "en", "b"), (5, "one", "en", "b"), (6, "One", "de", None), (7, "word " * 40_000, "en", "c"), (8, "x" * 30_000, "en", "c"), (9, "é\x00日本 𓀀", "fr", "c")]
    return frame(rows)
