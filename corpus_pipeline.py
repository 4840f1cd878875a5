"""Training-data pipeline over ``documents``: language, near duplicates, repeats, secrets, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phylospark.llm.common import materialised
from phylospark.llm.language import fit_language_model, identify_language
from phylospark.llm.neardup import drop_near_duplicates
from phylospark.llm.packing import pack_power_of_two
from phylospark.llm.secrets import redact_secrets
from phylospark.llm.substrings import drop_repeats


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without letters or far from every language go.

    So do null and empty texts. The model learns from the rows whose lang isn't null; with none of those nothing
    can be told, and no document stays. Rows are judged each by its whole text, repeated ones alike; ids may be
    null or repeat, and further columns stay as they are. An empty table stays empty.
    """
    model = fit_language_model(docs)
    return identify_language(docs, model).where(~F.col("rejected")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (words in fives, similarity 0.8): the one with the smallest id.

    Of rows with equal ids and equal texts one stays; unlike texts stay though they share an id or have none.
    A row without id goes before one with an id. Null, empty and blank texts are near nothing and all stay, as
    does a text of fewer than five words unless its words are the same. Very long texts are judged whole.
    """
    return drop_near_duplicates(docs, words=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 400 bytes or more, and the passages of over 50 words, that occur more than once.

    Every place of a repeat loses it, in the same document or another; whole rows stay, if need be with an
    empty text. Null texts stay null. Rows that repeat are each other's repeats.
    """
    return _recounted(drop_repeats(docs, words=51))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced by a mark; every row stays, null and empty texts as they are."""
    return _recounted(redact_secrets(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, no sequence across documents.

    A null or empty text is the end token alone. Rows that repeat are packed each. An empty table gives no rows.
    """
    return pack_power_of_two(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("repeats", repeats),
    ("secrets", secrets),
    ("packing", packing),
]

#: SQL can express neither the trained classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
