"""A training-data pipeline over `documents`: five stages, each one operator of lexigraph.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexigraph.llm import bpe, lines, mixing, quality, simhash
from lexigraph.llm.common import free_name
from lexigraph.session import written

#: Near-duplicates of the pipeline: shingles of five words, Jaccard similarity of 0.8 or more; fingerprints at four or fewer differing bits are the first candidates.
NEAR_WORDS, NEAR_BITS, NEAR_SIMILARITY = 5, 4, 0.8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the operator's threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    score = free_name("quality_score", docs)
    scored = quality.score_quality(docs, model, keep=tuple(docs.columns), out=score)
    return scored.where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows, columns of any other name are kept."""
    others = F.struct(*[docs[c] for c in docs.columns if c != "text"])
    kept = lines.dedup_lines(docs.select("doc_id", "text", others.alias("others")), keep=("others",))
    made = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return kept.select(*[made.get(c, F.col("others")[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near-duplicates."""
    return simhash.one_of_each_group(docs, words=NEAR_WORDS, bits=NEAR_BITS, similarity=NEAR_SIMILARITY)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number and the digests of ids and decoded text."""
    return bpe.token_digests(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_duplicates),
    ("mixing", mix),
    ("bpe encoding", encode),
]
#: No SQL: the classifier and the fingerprints are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
