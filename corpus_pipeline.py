"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's documents.

Every stage works on all rows that the one before has kept. A stage that filters keeps or drops whole rows and returns
the columns of its input, extra ones included, whatever their names; the last returns token ids by digest. A null text is
an empty one to every stage, and stays null where the row stays. Rows without id and rows that repeat an id are rows like
others, but in the near-duplicate stage, which keeps one of each class. An empty table gives an empty one. Whole texts are
read, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, order_minhash, quality, secret_scan
from millrace.llm import queries as q
from millrace.llm._common import cut, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labelled ones among them, does not reject: of a score of the threshold or more. Without usable labels all stay."""
    stats = cut(spark, quality.vectors(docs), "quality-stats")
    model = quality.fit(spark, stats, table(spark, sf_dir, "labels"))
    return docs.where(quality.score_of(model) >= quality.THRESHOLD)


def single(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each class of near-duplicates, one row of it; a class without ids keeps one row too."""
    return order_minhash.first_of_each(spark, docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text; empty texts hold none, and an empty benchmark has none."""
    leaks = decontamination.leaks(spark, table(spark, sf_dir, "benchmark"))
    return docs.where(~F.coalesce(leaks, F.lit(False)))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts replaced by marks and n_chars counted anew where a text has changed."""
    clean, changed = "clean", "changed"
    while {clean, changed} & set(docs.columns):
        clean, changed = f"_{clean}", f"_{changed}"
    found = docs.withColumn(clean, secret_scan.redacted("text"))
    found = found.withColumn(changed, ~F.col(clean).eqNullSafe(F.col("text")))
    columns = {"text": F.col(clean)}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col(changed), F.length(clean).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumns(columns).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return q.op5_byte_bpe(spark, sf_dir, docs)


STAGES = [("quality", good), ("near-duplicates", single), ("decontamination", unseen), ("secrets", without_secrets), ("encoding", encoded)]
ORACLE_SQL = None  # no SQL expresses the classifier, the alignments or the merges; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
