"""The corpus pipeline: raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor, and all but the last give the
columns of ``documents``. ``run`` writes what a stage gives as Parquet in the shared scratch folder and
goes on from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chatmeter.llm import mixing, packing, secrets, simhash, tokens, toxicity
from chatmeter.llm.tables import documents, saved

TOXIC_FROM = 0.7  # score of a document that is rejected
SHINGLE, MAX_BITS = 4, 4  # words of a shingle; bits in which near copies differ at most
REPEATS = 1.5  # passes over a source at most; no source is read less than once
CAPACITY = 4096  # tokens of a sequence


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity score is ``TOXIC_FROM`` or more."""
    return toxicity.clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXIC_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near copies."""
    return simhash.deduplicated(docs, SHINGLE, MAX_BITS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    return secrets.redacted(docs, secrets.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reads every document once, and blocks of small sources once more, by the temperature's weights."""
    return mixing.mixed(docs, mixing.Target(repeats=REPEATS)).drop("mix_epoch", "mix_place")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each piece of a document, with its sequence and place."""
    return packing.packed(docs, tokens.vocabulary_path(), CAPACITY)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", mask_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Learned scores and automata, hashes and token ids are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, applied to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
