"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read again as the input of the next.

toxic documents go; passages that an earlier document has are deleted; one
document of each near-duplicate group stays; benchmark passages are cut out;
the sources are mixed to their target weights.  Every stage but the last
returns the columns of documents; the last adds copies (how often the mix
repeats the document) and the words taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qualstar.llm import decontaminate, linededup, mixing, neardup, toxicity
from qualstar.llm.common import small_batches, table
from qualstar.session import delete_path, release_pins, scratch_path


def _begin(spark: SparkSession) -> None:
    """A stage's scratch tables are deleted when the next one starts: by then
    its output has been written and read again."""
    release_pins(spark)
    small_batches(spark)


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    # Learns from this stage's input and the labels beside it.
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def _line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return linededup.replace_text(docs)


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return neardup.one_of_each(docs)


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def _mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _begin(spark)
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", _toxicity),
    ("line dedup", _line_dedup),
    ("near duplicates", _near_duplicates),
    ("decontamination", _decontaminate),
    ("mixing", _mix),
]

#: The classifier, the diff and the random rounding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        # Kept apart from scratch tables, which each stage clears away.
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}", keep=True)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    release_pins(spark)
    return docs
