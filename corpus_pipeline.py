"""From raw documents to token ids: five stages, each one operator of ``tenure.llm``.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet and
reads it again as the next stage's documents. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.llm import mixing, pieces, repeats, simhash, toxicity
from tenure.llm.common import documents, labels
from tenure.operators.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TEXTS_PER_BATCH = 2_000
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; null and empty texts are not."""
    model = toxicity.fit(docs, labels(spark, sf_dir))
    return toxicity.keep_clean(docs.select(*COLUMNS), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints: the smallest id, see simhash.keep_first.

    Null and empty texts have no words and are one group; of repeated rows one stays.
    """
    return simhash.keep_first(docs.select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages seen in an earlier one; a document of repeats only goes.

    A letter cut in two goes with the passage. ``n_chars`` follows the text; a null text stays.
    """
    rows = docs.select(*COLUMNS).withColumn("_null", F.col("text").isNull())
    left = repeats.remove_repeats(rows, carry=("doc_id", "lang", "source", "_null"))
    text = F.when(~F.col("_null"), repeats.readable("kept"))
    kept = left.where("n_removed < n_bytes OR n_bytes = 0").withColumn("text", text)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Null and empty texts have no words and are not taken; ties and repeated rows are told apart at
    random by a fixed seed; a null source is a source.
    """
    return mixing.copied(docs.select(*COLUMNS))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every document; null and empty texts have no ids."""
    # Whole texts come in Arrow batches of so many rows; Spark's 10,000 take hundreds of MB in a task.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXTS_PER_BATCH)
    rows = pieces.encode(docs.select("doc_id", "source", "text"), PIECE_MODEL)
    return rows.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("repeats", cut_repeats),
    ("mix", mix),
    ("pieces", tokenise),
]

#: Learned scores, random rounding and segmentation are beyond SQL; tests compare by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
