"""A corpus pipeline: five operators in a row over the table documents.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns rows that
are written to the shared folder and read back as the next one's docs. All but the last return the
columns of documents; the last writes token files and returns what they hold for each document.
"""

from pyspark.sql import DataFrame, SparkSession

from windrose.llm.common import stored, table
from windrose.llm.decontaminate import decontaminated
from windrose.llm.language_id import recognised
from windrose.llm.simhash_dedup import MAX_BITS, SHINGLE_WORDS, without_near_duplicates
from windrose.llm.source_mix import mixed
from windrose.llm.token_files import public_tokenizer, tokenised


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that their labels teach; what is in none goes."""
    return recognised(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return without_near_duplicates(docs, SHINGLE_WORDS, MAX_BITS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for."""
    return mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and for each document what they hold."""
    return tokenised(docs, public_tokenizer())


STAGES = [
    ("language_id", language_stage),
    ("simhash_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mix", mixing_stage),
    ("token_files", token_stage),
]

#: Bloom filters, fingerprints, edit distances and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
