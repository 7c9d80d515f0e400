"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet under the shared checkpoint folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martkit.llm import line_dedup, mixing, ngram_join, quality_rules, sentence_pieces
from martkit.llm.common import stored, table
from martkit.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go from all of them."""
    return line_dedup.deduped(docs, min_docs=10, min_chars=1)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by five-word shingles at a similarity of 0.8 or
    more, directly or through others, one stays; documents without words stay."""
    return ngram_join.one_per_component(docs, 5, 4, 5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat, or go, as the target weights of their sources ask."""
    return mixing.mixed(docs, [3, 1, 2], (3, 2), 2)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_pieces, piece_ids`` of every row."""
    return sentence_pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_duplicates),
          ("mixing", mix), ("sentence_pieces", pieces)]

#: Learned thresholds, seeded draws and tokenization: tested against a
#: brute-force version in tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
