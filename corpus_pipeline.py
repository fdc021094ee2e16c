"""From raw documents to packed training bins, in five stages.

Each stage takes what its predecessor kept and returns the documents that it keeps,
with the columns of ``documents``; the last returns the packing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide.llm import common
from pagetide.llm.op1_best_fit_packing import best_fit_packing
from pagetide.llm.op3_exact_dedup import exact_dedup
from pagetide.llm.op6_source_mix import source_mix, word_count
from pagetide.llm.op7_quality_classifier import quality_scores
from pagetide.llm.op10_ngram_join import ngram_join


def _row(docs: DataFrame) -> Column:
    """All columns as one, whatever their names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects."""
    scored = quality_scores(docs, common.table(spark, sf_dir, "labels"), keep_row=True)
    return scored.where("predicted = 1").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of rows that repeat its id too, one."""
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("kept_id"), "text_sha256").distinct()
    content = F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest")
    marked = docs.select("doc_id", content, _row(docs))
    same = marked["doc_id"].eqNullSafe(kept["kept_id"]) & (marked["digest"] == kept["text_sha256"])
    stays = marked.join(kept, same, "left_semi")
    return stays.dropDuplicates(["doc_id", "digest"]).select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of smallest id; documents
    without id, which take no part, stay."""
    first = ngram_join(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("first_id"))
    return docs.join(first, docs["doc_id"].eqNullSafe(first["first_id"]), "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as the mix takes the most of it.

    A document of which the schedule takes some words comes once for every round of
    its source begun with it; one of which it takes none goes.
    """
    taken = source_mix(docs).where("taken > 0")
    times = F.ceil(F.max(F.col("taken") / F.col("size"))).cast("int").alias("times")
    wanted = taken.groupBy(F.col("doc_id").alias("taken_id")).agg(times)
    rows = docs.select("doc_id", _row(docs))
    met = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["taken_id"]))
    return met.select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in bins, copies of a document in different ones."""
    return best_fit_packing(docs, size=word_count(F.col("text")), cluster=F.xxhash64("text"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mix),
    ("packing", pack),
]

#: Classifier, near duplicates and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each stored and read back before the next."""
    docs, before = common.table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
        common.discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
