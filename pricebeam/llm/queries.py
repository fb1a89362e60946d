"""The registered query of each operator, over its whole table with production parameters, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricebeam.llm import lexical, quality, substrings, warc
from pricebeam.llm.bilinear import score_texts
from pricebeam.llm.decontaminate import overlaps
from pricebeam.llm.descent import nearest
from pricebeam.llm.html_text import extract_text
from pricebeam.llm.lexical import ranked_search
from pricebeam.llm.pieces import encode_pieces
from pricebeam.llm.simhash import simhash_components
from pricebeam.llm.substrings import remove_repeated_windows
from pricebeam.llm.suffixes import remove_repeated_bytes
from pricebeam.llm.token_counts import count_tokens
from pricebeam.llm.variants import spelling_variants
from pricebeam.llm.warc import archived_history

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL for those that it can express.
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")


@query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text, and the text they decode to."""
    return encode_pieces(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), scores="rank",
                         decoded="decoded").select("doc_id", "n_pieces", "ids", "decoded")


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(_pages(spark, sf_dir)).select("page_id", "url", "text", "n_chars")


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; the source is the host."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return quality.judged(docs, host="source").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op3_quality_rules"] = quality.ORACLE
ORACLES["op4_substring_dedup"] = substrings.ORACLE
ORACLES["op5_warc"] = warc.ORACLE


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left when every 35-word passage that occurs twice is removed."""
    return remove_repeated_windows(_documents(spark, sf_dir), window=35).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, read back and merged into one ordered history."""
    return archived_history(_pages(spark, sf_dir)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "urlkey", "timestamp")


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and log-bilinear log-probabilities of every whole text, learned from four fifths of them."""
    return score_texts(_documents(spark, sf_dir), fold=1).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text by the 50k byte-level vocabulary."""
    return count_tokens(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 64-bit fingerprints differ in at most 4 bits."""
    return simhash_components(_documents(spark, sf_dir), shingle=4, distance=4)


@query
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left when every 200-byte string that occurs twice is removed."""
    return remove_repeated_bytes(_documents(spark, sf_dir), window=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of every document with every benchmark item."""
    return overlaps(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@query
def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of all vectors for every vector whose id 20 divides."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"), count=20)


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for every benchmark item."""
    return ranked_search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), count=20)


ORACLES["op12_ranked_search"] = lexical.ORACLE


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return spelling_variants(_documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")
