"""The queries of this subpackage, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetide import session
from pagetide.llm import common
from pagetide.llm.op1_best_fit_packing import best_fit_packing
from pagetide.llm.op10_ngram_join import ngram_join
from pagetide.llm.op11_hard_negatives import hard_negatives
from pagetide.llm.op12_periodic_runs import periodic_runs
from pagetide.llm.op13_line_dedup import line_dedup
from pagetide.llm.op2_token_shards import token_shards
from pagetide.llm.op3_exact_dedup import exact_dedup
from pagetide.llm.op4_topk_search import topk_search
from pagetide.llm.op5_html_extraction import main_text
from pagetide.llm.op6_source_mix import source_mix, word_count
from pagetide.llm.op7_quality_classifier import quality_scores
from pagetide.llm.op8_token_counts import token_counts
from pagetide.llm.op9_suffix_dedup import suffix_dedup


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return best_fit_packing(docs, size=word_count(F.col("text")), cluster=F.xxhash64("text"))


def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards(common.table(spark, sf_dir, "documents"), session.run_folder(spark, "shards"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(common.table(spark, sf_dir, "documents"))


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(common.table(spark, sf_dir, "embeddings"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(common.table(spark, sf_dir, "pages"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(common.table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(common.table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(common.table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text, but for ids whose CRC-32 is divisible by 10 its words repeat from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        start = F.pmod(g, n)
        period = 1 + F.floor((n - start) / (3 + g % 8))
        at = lambda i: F.when(i < start, i).otherwise(start + F.pmod(i - start, period))
        return F.transform(words, lambda _, i: F.get(words, at(i).cast("int")))

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    # one element, so that the words are made once
    changed = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")).otherwise(text))
    return F.when(h % 10 == 0, F.get(changed, F.lit(0))).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = periodic_runs(docs.withColumn("text", with_planted_period(F.col("doc_id"), F.col("text"))))

    def order(a: Column, b: Column) -> Column:
        """Runs by length over period, the greatest first; then by start and period."""
        more = a["length"] * b["period"] - b["length"] * a["period"]
        by_place = F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["period"] - b["period"])
        return F.when(more != 0, -F.signum(more)).otherwise(F.signum(by_place)).cast("int")

    best = F.get(F.array_sort("runs", order), F.lit(0))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(common.table(spark, sf_dir, "documents")).drop("kept_text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_token_shards": op2_token_shards,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_topk_search": op4_topk_search,
    "op5_html_extraction": op5_html_extraction,
    "op6_source_mix": op6_source_mix,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_counts": op8_token_counts,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}
