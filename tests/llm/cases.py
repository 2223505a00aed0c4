"""Awkward rows that every operator of lendlens.llm must take."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
PROSE = " ".join(f"plain{i} words{i}" for i in range(40)) + "."


def awkward(spark):
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, "   \n\t ", None, None, 5), (None, PROSE, "en", "a", 9),
        (4, PROSE, "en", "a", 9), (4, PROSE, "en", "a", 9), (5, PROSE, None, "a", 9), (6, LONG, "en", None, 1),
        (7, "one", "de", "b", 3), (8, "\x01 a\x02b \x00c é中文 \U0001F600", "de", "b", 3), (None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def clashing(df, *names):
    """``df`` with further columns of the names that an operator uses."""
    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf_dir="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
