"""The corpus pipeline: documents go through the stages one after the other, each written and read again.

A stage takes all that the one before it kept. Columns of the documents pass through untouched, whatever
their names, but for the text and its length where secrets are masked; the last stage returns the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import decontaminate, mix, near_dedup, secrets_scan, toxicity
from llm.common import kept, table


def _wrapped(docs: DataFrame) -> DataFrame:
    """All but the text as `_row` beside the columns that operators use, so that theirs clash with none.

    A text passes through Python and back once, not a second time within the row.
    """
    return docs.select(F.struct("*").dropFields("text").alias("_row"), "doc_id", "text", "source")


def _unwrapped(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, in their order."""
    return found.select(*[(F.col("text") if c.lower() == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns])


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labels of the documents it is given."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return _unwrapped(toxicity.scored(_wrapped(docs), model).where("predicted = 0"), docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id stays."""
    return near_dedup.first_of_each(docs)


def not_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which a twentieth or more lies in windows of the benchmark."""
    found = decontaminate.hits(_wrapped(docs), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit()
    return _unwrapped(found.where(~((hit > 0) & (hit * 20 >= F.col("n_words")))), docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; all documents stay."""
    done = secrets_scan.masked(_wrapped(docs))
    if "n_chars" in docs.columns:
        done = done.withColumn("_row", F.col("_row").withField("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)))
    return _unwrapped(done, docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mix.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", not_toxic),
    ("near_dedup", one_of_each),
    ("decontamination", not_contaminated),
    ("secrets", without_secrets),
    ("mixing", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Signatures, the classifier and the forest are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
