"""Corpus pipeline: five stages over `documents`, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, linededup, mixing, ngram_join, quality
from tidemark.llm.common import documents, saved


def _aside(docs: DataFrame, *made: str) -> DataFrame:
    """docs with columns that a stage makes under another name for the while."""
    return docs.withColumnsRenamed({c: f"_own_{c}" for c in made if c in docs.columns})


def _back(out: DataFrame, docs: DataFrame, *made: str) -> DataFrame:
    """The columns of docs, those that were put aside too."""
    aside = [c for c in made if c in docs.columns]
    return out.drop(*aside).withColumnsRenamed({f"_own_{c}": c for c in aside}).select(*docs.columns)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose quality score is under the threshold; the network is fitted on this input and the labels.

    Null and empty texts have a score like others; equal texts stay or go alike.
    """
    net = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _back(quality.score(_aside(docs, "score"), net).filter(F.col("score") >= quality.THRESHOLD), docs, "score")


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated three-line windows; n_chars follows the text. Documents of which no word is left go.

    Null and empty texts stay as they are; of a row that is repeated, one keeps its lines.
    """
    made = ("n_lines", "n_removed", "removed")
    out = linededup.dedup_lines(_aside(docs, *made))
    gone = (F.col("n_removed") > 0) & (F.col("n_removed") == F.col("n_lines"))
    return _back(out.filter(~gone).withColumn("n_chars", F.length("text").cast("long")), docs, *made)


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the least doc_id of each group of near duplicates: five words, similarity 0.8.

    Texts without words are in no group and stay; of repeated rows one stays.
    """
    return ngram_join.keep_one(docs, k=5, num=4, den=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, shard by shard; texts without words add none, taken or not."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded text for each row of the mix; null and empty texts have none and digests of ""."""
    return bpe.encode_digests(docs)


# All stages take an empty table and columns named like their own, which keep their values up to the last stage.
STAGES = [
    ("quality classifier", classify),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_ngrams),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode),
]

#: A learned filter comes first: SQL cannot give its rows. Each stage is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
