"""Documents made ready for training, in five stages. Each stage gets all that the one before kept, as
Parquet, and all but the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebeam.llm.decontaminate import without_overlaps
from pricebeam.llm.pieces import encode_pieces
from pricebeam.llm.quality import judged
from pricebeam.llm.simhash import one_of_each_group
from pricebeam.llm.substrings import remove_repeated_windows
from pricebeam.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return judged(docs, host="source").filter("kept").select(*docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return one_of_each_group(docs, shingle=4, distance=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated passages of 35 words go, and documents of which nothing is left. Documents
    without such a passage stay as they are."""
    cut = remove_repeated_windows(docs, window=35).filter("n_removed = 0 OR n_removed < n_words")
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
                          .otherwise(F.col("n_chars"))).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces; its text is what they decode to."""
    coded = encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), scores="rank", decoded="decoded")
    return coded.select(*[F.col("decoded").alias("text") if c == "text" else c for c in docs.columns], "n_pieces", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Fingerprints, their groups and Viterbi paths are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; each stage's rows are written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
