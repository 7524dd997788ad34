"""The queries of this subpackage, each over its whole table, and SQL where it can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import bpe, langid, neighbours, packing, pii, quality_model, quality_rules, simhash, token_counts, token_files


def _over(table: str, op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels, pages = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "pages"))
    return quality_model.with_quality(documents, labels, pages)


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": _quality,
    "op2_personal_data": _over("documents", pii.personal_data),
    "op3_token_blocks": _over("documents", token_files.token_blocks),
    "op4_language_id": _over("documents", langid.language_id),
    "op5_token_counts": _over("documents", token_counts.token_counts),
    "op6_byte_pairs": _over("documents", bpe.byte_pairs),
    "op7_packing": _over("documents", packing.packed),
    "op8_nearest_neighbours": _over("embeddings", neighbours.neighbours),
    "op9_near_duplicates": _over("documents", simhash.near_duplicates),
    "op10_quality_rules": _over("documents", quality_rules.quality_rules),
    "pipeline": _pipeline,
}
SQL: dict[str, str] = {}
