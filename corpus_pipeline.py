"""The corpus pipeline: language ID, quality rules, near-dedup, substring dedup, packing.

Every stage takes what its predecessor kept and returns documents (doc_id, text, lang, source,
n_chars); the last returns packed pieces. Rows whose text a stage changes get a new n_chars.

A stage's result is written before the next stage starts, so the next stage first removes the
tables that its predecessor saved on the way; no stage carries the disk of the earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxstats.llm import lang_id, near_dup, packing, quality, substring
from boxstats.llm.common import recorded, removed, saved, small
from boxstats.sources.tables import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

# A document whose best language is less likely than this, given its text, is rejected.
LEAST_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters and those whose language stays doubtful. The label column is
    used to fit the model only."""
    found = lang_id.identify(docs, lang_id.fit(docs), carry=COLUMNS[2:])
    sure = (F.col("lang_pred") != lang_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.where(sure).select("doc_id", "text", "carried.*")


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents by the base rules and depleted ones; the others lose their boilerplate
    lines: those of more than 20 different texts, however many texts the source has."""
    judged = quality.quality(docs, carry=("lang", "source")).where("kept")
    return judged.select("doc_id", F.col("clean_text").alias("text"), "carried.*",
                         F.length("clean_text").cast("long").alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near-duplicates."""
    gone = near_dup.near_duplicates(docs).where("NOT kept").select("doc_id")
    gone = saved(gone.distinct(), "near-copies")
    return docs.join(small(gone), "doc_id", "left_anti").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes word sequences that occur more than once; the rows stay."""
    left = substring.dedup_substrings(docs, carry=("lang", "source"))
    return left.select("doc_id", F.col("kept_text").alias("text"), "carried.*",
                       F.length("kept_text").cast("long").alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# By application and stage: the folders that the stage's result still reads.
FOLDERS: dict[tuple[str, str], list[str]] = {}


def after(before: str | None, name: str, stage: Stage) -> tuple[str, Stage]:
    """The stage, which begins by removing the saved tables of the one before."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        removed(spark, FOLDERS.pop((application, before), []))
        with recorded() as folders:
            result = stage(spark, docs, sf_dir)
        FOLDERS[application, name] = folders
        return result
    return name, run_stage


STAGES = [after(None, "language_id", language), after("language_id", "quality_rules", rules),
          after("quality_rules", "near_dedup", near_dedup),
          after("near_dedup", "substring_dedup", substring_dedup),
          after("substring_dedup", "packing", pack)]

# SQL can express neither the language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written before the next reads it."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
