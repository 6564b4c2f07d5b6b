"""Awkward rows that every operator has to take."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LONG = " ".join(f"word{i % 977} and" for i in range(30_000))
ROWS = [
    (0, "One fine line.\nAnother fine line follows here.", "en", "a", 1),
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \t\n ", "en", "b", 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, "One fine line.\nAnother fine line follows here.", "en", None, 1),
    (5, "One fine line.\nAnother fine line follows here.", "en", None, 1),
    (None, "One fine line.\nAnother fine line follows here.", None, "c", None),
    (None, None, None, None, None),
    (7, "héllo wörld 日本語 \U0001f600 end", "fr", "c", 5),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
