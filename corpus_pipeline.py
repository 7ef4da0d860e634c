"""From raw documents to packed sequences: quality, toxicity, near duplicates, packing.

Each stage takes (spark, docs, sf_dir), works on every document that its predecessor kept, and
returns the columns of documents; the last returns the pieces of the packed sequences. ``run`` writes
each stage's rows to the shared folder and reads them again for the next.

Scores are computed beside the other columns, so every row is judged for itself: rows of null or
repeated doc_id, null and empty texts, and columns of any other name pass through the filters like
all others. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.ngram_join import one_of_each_group
from quayside.llm.packing import pack_documents
from quayside.llm.quality import quality_model, quality_score, statistics_of
from quayside.llm.queries import STAGE_BATCH, prepare, table, tokenizer
from quayside.llm.toxicity import fit_toxicity, toxicity_score
from quayside.session import scratch_path

#: Score from which a document has label 1.
THRESHOLD = 0.7


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier gives label 1."""
    prepare(spark, STAGE_BATCH)
    name = "statistics"
    while name in {column.lower() for column in docs.columns}:
        name += "_"
    # Texts are measured once, and go on beside their statistics.
    path = scratch_path(spark, "pipeline-statistics")
    docs.withColumn(name, statistics_of(F.col("text"))).write.parquet(path)
    measured = spark.read.parquet(path)
    model = quality_model(measured.select("doc_id", F.col(name).alias("statistics")), table(spark, sf_dir, "labels"))
    return measured.where(quality_score(model, F.col(name)) >= THRESHOLD).select(docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not give label 1."""
    prepare(spark, STAGE_BATCH)
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(model, F.col("text")) < THRESHOLD)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of least doc_id."""
    prepare(spark, STAGE_BATCH)
    return one_of_each_group(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with their token ids, in sequences of 2048 tokens."""
    prepare(spark, STAGE_BATCH)
    return pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality", good_quality), ("toxicity", not_toxic), ("near_duplicates", no_near_duplicates), ("packing", packed)]
#: Trained scores and tokenizers have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
