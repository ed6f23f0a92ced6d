"""From raw documents to token ids: five stages, each over all that its predecessor kept.

STAGES holds (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents. SQL can express
neither the networks nor the tilings, so ORACLE_SQL is None and tests hold the stages against brute force.

Defined results, for every stage: whole rows travel, with columns beyond those of documents and with names that clash
with ours; repeated rows, rows without doc_id and null columns are treated as each stage says; an empty table gives an
empty table of the same columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from claimlens.llm import dac, decontaminate, mixing, simhash, toxicity
from claimlens.plans.staging import Staging

ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold.

    Each row is judged by its text alone; null, empty and wordless texts score as an empty window. Without labels of
    both classes every row stays.
    """
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: the smallest doc_id, of equal ones the smallest row hash.

    Null, empty and wordless texts are copies of one another. Rows without doc_id are held against each other alone.
    """
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item. Null and empty texts leak nothing; repeated rows go or stay together."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row once at least; those of small sources again, as the target weights ask.

    A null source is a source of its own; rows without tokens come back with their block.
    """
    return mixing.mix(docs).select(docs.columns)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row as directly addressable codes, reported from the files.

    Rows that were mixed in several times are written each time; a null text is the end id alone.
    """
    path = Staging(spark, "dac").path("ids")
    dac.write(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return dac.read(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
    ("token_id_output", write_token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of sf_dir."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
