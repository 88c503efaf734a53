"""The corpus pipeline: five stages over ``documents``, each calling one operator of ``strata.llm``.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame,
which ``run`` writes as Parquet into the shared folder and rereads as the next stage's ``docs``. All stages
but the last return the columns of ``documents``, those with names that an operator uses for its results
included. Rows with nulls, empty texts, repeated rows and empty tables go through every stage as the
operators define it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common, decontaminate, line_dedup, packing, quality, simhash
from strata.llm.queries import tokenizer_path


def _own_columns(docs: DataFrame, results: tuple[str, ...], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after ``operator``, which would replace those named like its ``results``: these go
    through it under another name."""
    clash = [c for c in docs.columns if c.lower() in results]
    aside = dict(zip(clash, common.internal(docs, *(f"__own_{c}" for c in clash)), strict=True))
    out = operator(docs.withColumnsRenamed(aside))
    return out.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does."""
    results = (*quality.COUNTS, "base_failed", "host_failed", "kept")
    return _own_columns(docs, results, lambda d: quality.judged(d).where("kept"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents keep; ``n_chars`` follows the text."""
    out = _own_columns(docs, ("n_lines", "n_dropped"), line_dedup.dedup_lines)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.clean(docs, common.read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that stay, packed into sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", drop_contaminated), ("curve_packing", pack)]

#: The last stage's rows depend on a tokenizer, which SQL does not have; tests/llm/test_pipeline.py holds every stage
#: and ``run`` against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
