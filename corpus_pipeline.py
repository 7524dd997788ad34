"""A corpus from documents: quality rules, language, near duplicates, personal data, packing.

Nulls in any column are allowed, and so are empty and very long texts, repeated rows and further columns, whatever
their names; an empty table gives an empty corpus. All stages but the last give rows with the columns they got.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm.langid import reject_unknown_language
from lodestrata.llm.packing import packed
from lodestrata.llm.pii import redact_personal_data
from lodestrata.llm.quality_rules import reject_low_quality
from lodestrata.llm.scratch import shared_dir
from lodestrata.llm.simhash import keep_one_of_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep; null and blank texts go, repeated rows share their fate."""
    return reject_low_quality(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose language is told; null and letterless texts go, repeated rows share their fate."""
    return reject_unknown_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least doc_id (nulls last); one of repeated rows.
    Null texts stay."""
    return keep_one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its type and n_chars to match; a null text stays null."""
    return redact_personal_data(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins: bin_id, place, doc_id, start, n_tokens. A null or empty text has one row without a bin; repeated
    rows are packed each."""
    return packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can't express a trained classifier, so the stages are tested one by one against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read by the next.

    A stage's folder is deleted when the next one is written; that of the bins, which are returned, stays.
    """
    to = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(to).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (name, stage) in enumerate(STAGES):
        at = f"{to}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        if before:
            files.delete(path(before), True)
        before = at
    return docs
