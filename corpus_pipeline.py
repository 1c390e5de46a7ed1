"""A corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet in
the shared folder and read again as the next one's documents.  All but the last return the columns
of ``documents``, further ones included, whatever they are called.  Every stage takes an empty table
and gives one; texts are taken whole, however long; null ids, null and empty texts, repeated rows and
rows that repeat an id with another text have the results that each stage states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import decontaminate, linededup, packing, simhash, toxicity
from tideline.llm.common import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.  Each row is judged by its own text; a null text counts
    as empty, and an empty one has no toxic word and stays unless labels say that most texts are
    toxic.  Repeated rows go or stay together."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in an earlier document, or nearly so, are cut out; no document goes.  Null texts
    and rows without an id stay as they are; rows that repeat an id with another text are documents
    of their own, repeated rows keep the same lines."""
    return linededup.dedup_lines(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents, by SimHash or by five-word shingles with a similarity of 0.8 or
    more, the one with the smallest doc_id stays, of repeated rows one.  Null
    and empty texts are copies of each other; rows without an id stay."""
    return simhash.keep_one(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.  Each row is judged by its own text; null and
    empty texts stay."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences.  Null and empty texts are one
    token; repeated rows are packed each for itself."""
    return packing.best_fit(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("best_fit_packing", pack),
]

#: The stages can't be expressed in SQL; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
