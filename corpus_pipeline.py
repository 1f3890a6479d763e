"""A training corpus from ``documents``: language, near-duplicates, benchmark passages, mix, token ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwire.llm import decontamination, jaccard_join, language_id, mixing, token_output
from spoolwire.llm.common import materialize, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network recognises; those without a letter, or below the least score, go.

    ``lang`` becomes the predicted language where the document has none.
    """
    model = language_id.fit(docs.where(~language_id.held_out()))
    found = language_id.identify(docs, model, keep=tuple(docs.columns))
    kept = found.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= language_id.MIN_SCORE))
    return kept.select(*[F.coalesce("row.lang", "lang_pred").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard_join.one_per_component(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights, repeated where a target asks for it."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's token ids, read back from the shards."""
    return token_output.write_and_digest(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

#: The network of the first stage can't be expressed in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
