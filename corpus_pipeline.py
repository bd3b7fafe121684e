"""The corpus pipeline: documents in, packed sequences out.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before kept and returns
the columns of documents, but for the last. Between stages the rows are written as Parquet
and read again, so a lost executor costs no more than its part of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.llm.decontaminate import without_contaminated
from tidegrid.llm.near_dups import near_duplicates
from tidegrid.llm.packing import pack
from tidegrid.llm.quality_model import fit_quality, with_quality
from tidegrid.llm.substrings import without_repeats
from tidegrid.sources.stage import stage

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = "score"
    while score in docs.columns:
        score += "_"
    scored = with_quality(docs, fit_quality(docs, labels), score_col=score)
    return scored.where(F.col(score) >= 0.3).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; documents without an id all stay."""
    copies = stage(near_duplicates(docs).where("NOT kept").select("doc_id"), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that begin anywhere else too; all documents stay."""
    cut = without_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All texts in sequences of 4096 tokens: one row a piece, with its ids."""
    return pack(docs, WORD_BPE)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Stages train a model, search substrings and measure edit distances: no SQL says that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, fn in STAGES:
        docs = stage(fn(spark, docs, sf_dir), name)
    return docs
