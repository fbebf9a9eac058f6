"""The corpus pipeline over ``documents``; part of the llm subpackage.

Quality rules, line dedup, SimHash near-dedup, source mixing, byte-level BPE. Every stage
takes the documents its predecessor kept; all but the last return documents' columns.

Cases, for every stage: columns beyond documents' own pass through untouched, whatever their
names; an empty table gives an empty result; null ids, languages and sources are values like
others. What a stage does with null and empty texts, ties and repeated rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaplytics.llm import bpe, line_dedup, mixing, quality, simhash
from snaplytics.llm.common import drop_staged, last_staged, only_kept, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the outlier test reject go. Null and empty texts have no words and go;
    repeated rows are judged alike."""
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines go; every document stays. Of equal lines the first by document and
    line number stays; null, empty and blank texts stay as they are; rows that repeat id and text are one document."""
    return line_dedup.dedup_lines(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the least ``doc_id`` (null only when there is no other).
    Null and empty texts share fingerprint zero; of rows that repeat an id one stays."""
    return simhash.dedup(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a text without words weighs nothing and goes
    with its source's whole epochs. Equal keys are ordered by id and text, so reruns agree; repeated rows go together."""
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded text, for every row; a null text is empty."""
    return bpe.encode_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("mix_sources", mix),
    ("bpe", encode),
]

#: Fingerprints, tokens and edit joins are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's result written and read back. A stage's own staged
    tables go once its result is written, and so does the result it read."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with only_kept(spark) as kept:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", "zstd")
            kept.append(last_staged())
        drop_staged(spark, before)
        before = kept
    return STAGES[-1][1](spark, docs, sf_dir)
