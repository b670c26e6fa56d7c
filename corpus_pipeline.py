"""From documents to packed training sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneloom.llm import jaccard, langid, mixing, packing, quality
from paneloom.llm.queries import vocabulary
from paneloom.store import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts; documents that fail or lose too much go whole."""
    return quality.kept_documents(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``lang`` becomes the predicted language; documents outside all centroids' radius go."""
    model = langid.fit_languages(docs.where(langid.learnable()), order=F.col("doc_id"))
    return langid.accepted_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by five-word shingles at 0.8, the document with the smallest id stays."""
    return jaccard.first_of_groups(docs, width=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the sequences, with their token ids; a repeated document is packed as often."""
    pieces = packing.pack(packing.tokenize(docs, vocabulary()))
    return pieces.select("row.doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("language", language),
    ("near duplicates", near_duplicates),
    ("source mix", source_mix),
    ("packing", packed),
]

#: Trained centroids and a tokenizer's ids have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
