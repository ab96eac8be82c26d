"""From raw documents to token files, in five stages over the ``documents`` table.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of ``documents``, with the values
that they came with, whatever their names: an operator sees the columns that it reads, the others travel
beside them. Null and empty texts fail the quality rules; an empty table stays empty; repeated rows (equal
id and text) are one row after the near-duplicate stage; null ids sort last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseline.llm import decontaminate, mixing, ngram_join, quality_rules, token_files
from caseline.llm.common import table, written
from caseline.llm.queries import MIX_WEIGHTS, tokenizer_path


def kept_beside(docs: DataFrame, read: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that ``work`` returns, with all columns of ``docs``; ``work`` sees the columns in ``read`` alone."""
    rest = [c for c in docs.columns if c not in read]
    beside = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None)
    name = "beside"
    out = work(docs.select(*read, beside.alias(name)))
    return out.select(*[F.col(name)[c].alias(c) if c in rest else F.col(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return kept_beside(docs, ["text"], lambda d: quality_rules.quality(d).where("kept"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class, the one with the smallest id."""
    return kept_beside(docs, ["doc_id", "text"], ngram_join.one_per_class)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    items = table(spark, sf_dir, "benchmark")
    return kept_beside(docs, ["doc_id", "text"], lambda d: decontaminate.without_leaks(d, items))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by the rate of their source, in a global random order."""
    return kept_beside(docs, ["doc_id", "text", "source"], lambda d: mixing.mixed(d, MIX_WEIGHTS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, as the index read back from them."""
    return token_files.tokens_of(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

#: Near-duplicate classes are connected components of an approximate search and token ids come from a
#: tokenizer, so SQL cannot express the rows; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; between two stages the rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
