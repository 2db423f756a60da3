"""A training corpus from raw documents, in five stages; each is written and reread by the next.

1. language: documents whose language cannot be told are rejected, the others get the language found.
2. near_duplicates: one document of each class of near-duplicates stays.
3. personal_data: personal data in the texts is replaced by its kind.
4. mixing: documents are drawn to the target weights; one that is read in two epochs stands twice.
5. tokens: texts become token ids, with a digest of the text that decoding gives back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.llm import bpe, langid, mixing, neardup, pii
from drumlin.llm.common import bounded, staged, table, unused
from drumlin.llm.queries import vocabulary

#: Least probability of the language found.
SURE = 0.5
#: Texts that a worker is handed at once, in all stages.
BATCH = 2048


def _around(docs: DataFrame, results: tuple[str, ...], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stage whose results have names that the documents' own columns may have too."""
    aside = {c: unused(f"{c}_", docs.columns) for c in results if c in docs.columns}
    found = stage(docs.withColumnsRenamed(aside))
    return found.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark, BATCH)

    def stage(rows: DataFrame) -> DataFrame:
        found = langid.identify(rows, langid.train(docs))
        kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= SURE))
        return kept.withColumn("lang", F.col("lang_pred"))

    return _around(docs, ("lang_pred", "score"), stage)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark, BATCH)
    return neardup.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark, BATCH)
    found = pii.redact(docs, pii.train(docs))
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _around(docs, ("epoch",), mixing.registered)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded(spark, BATCH)
    file = vocabulary()
    # Written between: else two workers of a core hold the vocabulary, each for its half.
    ids = staged(bpe.encode(docs.select("doc_id", "lang", "source", "text"), file), "pipeline-ids")
    both = bpe.decode(ids, file)
    return both.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.col("text"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixed),
    ("tokens", tokens),
]

#: The language model, the verification of near-duplicates and the tagger are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
