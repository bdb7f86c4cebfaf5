"""Small tables for the corpus operators."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"w{i % 977} x{i % 31}" for i in range(60_000))
EDGES = [
    (1, None, None, None, None),
    (2, "", "en", "src1", 0),
    (3, " \t\n ", "en", "src1", 4),
    (4, "one", "en", "src1", 3),
    (5, "one two", "de", "odd name", 7),
    (6, LONG, "en", "src2", len(LONG)),
    (7, LONG + " end", None, "src2", len(LONG) + 4),
    (8, "Übergröße und Straße 東京 😀 " * 20, "de", "src3", None),
    (8, "Übergröße und Straße 東京 😀 " * 20, "de", "src3", None),
    (None, "a text without a number of its own, which is long enough to repeat in other places", "en", "src0", 3),
    (10, "a text without a number of its own, which is long enough to repeat in other places", "en", "src0", 3),
    (11, "a  text without a number of its own, which is long enough to repeat in other places", "en", "src0", 3),
]


def docs(spark, rows, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def edges(spark):
    """The edge rows, with extra columns named like the operators' own."""
    return docs(spark, EDGES).selectExpr(
        "*", "1 AS node", "'x' AS digest", "2 AS row", "3 AS kept", "4 AS keep_id", "5 AS kept_id", "6 AS known", "7 AS n_tokens", "8 AS component_id", "9 AS mixed_id", "0 AS score", "'y' AS Row2"
    )


def empty(spark):
    return docs(spark, [], 1)


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", F.col("text")).collect()]
