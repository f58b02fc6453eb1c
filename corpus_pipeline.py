"""A training-corpus pipeline over ``documents``: five stages, each an operator.

Every stage but the last returns the columns of ``documents``; what it rejects
or changes is gone for the next one.  ``run`` writes each stage's rows to the
cluster's shared folder and reads them back for the next.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bpe, decontam, jaccard, pii, toxicity
from panelspark.llm.catalog import tokenizer_path
from panelspark.llm.tables import table, written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the held-out labels are not learned."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=~toxicity.held_out(F.col("doc_id")))
    return toxicity.score(docs, model).where(F.col("score") < toxicity.THRESHOLD).select("row.*")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones (five-word shingles, 0.8)."""
    return jaccard.keep_one(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontam.scan(docs, table(spark, sf_dir, "benchmark")).where("NOT contaminated").select("row.*")


def personal_data_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind; ``n_chars``
    of a changed text is counted anew."""
    model = pii.train(pii.labelled_by_patterns(docs))
    return pii.masked(docs, model)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the round trip."""
    return bpe.encode(docs, tokenizer_path, keep_decoded=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_out),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", uncontaminated),
    ("personal_data", personal_data_masked),
    ("bpe", encoded),
]

#: The learned stages have no SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the ``documents`` of ``sf_dir``."""
    return reduce(lambda docs, stage: written(stage[1](spark, docs, sf_dir), stage[0]), STAGES, table(spark, sf_dir, "documents"))
