"""Shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The characters that separate words, as a Java and as a Python byte class.
BLANKS = "\\x20\\x09-\\x0D"
WORD = f"[^{BLANKS}]+"
BLANK_RUN = f"[{BLANKS}]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_of(c: Column | str) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fold(doc_id: Column | str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``: the split into training and held-out rows.

    A null id counts as the empty text, so it has a fold too.
    """
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return (F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` as text and the columns named, for a trip through pandas.

    A whole number column with nulls would arrive there as floating point.
    """
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), *columns)
