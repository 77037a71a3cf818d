"""A training-data pipeline over ``documents``: five stages, each written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the
last return the columns of ``documents``.

Defined results: a null text has no letter, so the first stage drops it.  Null ids are ids like any
other: they come first where order decides, and of near duplicates the least id stays.  Repeated rows
are near duplicates of each other.  An empty table gives no rows.  Texts are read whole; extra
columns, whatever their names, stay to the fourth stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keyfig.llm import decontaminate, langid, linededup, neardup, packing
from keyfig.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that read like one of the languages; texts without letters or unlike all go.

    Model and limits come from all labelled documents.
    """
    found, name = langid.predict(docs, langid.fit(docs, sample_docs=None))
    return found.where(langid.fits(F.col(f"`{name}`"), langid.limits(docs))).drop(name)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines are deleted; documents of which nothing is left go."""
    cleaned, name = linededup.dedup(docs)
    left = F.trim(F.translate(F.coalesce("text", F.lit("")), "\n", " ")) != ""
    return cleaned.where((F.col(f"`{name}`.n_removed") == 0) | left).drop(name)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), null_ids=True)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard),
          ("decontamination", decontamination), ("best_fit_packing", best_fit_packing)]

#: Language models, near duplicates and packing are beyond SQL; tests hold run() to a plain model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
