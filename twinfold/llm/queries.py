"""The registered queries of this subpackage, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinfold.llm.common import table, text_or_empty
from twinfold.llm.conversations import repair_conversations, report
from twinfold.llm.decontam import decontaminate
from twinfold.llm.exact_dedup import exact_dedup
from twinfold.llm.kneser_ney import score_held_out
from twinfold.llm.language import identify_languages
from twinfold.llm.licenses import scan_licenses
from twinfold.llm.packing import pack_documents
from twinfold.llm.periodic_runs import find_runs, most_repeated
from twinfold.llm.secrets import scan_secrets
from twinfold.llm.simhash import simhash_components
from twinfold.llm.url_rules import judge_urls
from twinfold.llm.warc import archive_pages
from twinfold.llm.window_packing import pack_windows

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# The rules of the contract.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_held_out(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark, table(spark, sf_dir, "pages"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_windows(table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def planted_periods(documents: DataFrame) -> DataFrame:
    """``doc_id, text``: documents whose checksum of the id ends in 0 repeat a stretch of themselves
    from some word to their end, as the contract says; the others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False)) & F.col("text").rlike(r"[^ \t-\r]")
    rows = rows.withColumns({"words": F.when(chosen, words), "g": F.floor(h / 10)})
    n = F.size("words")
    rows = rows.withColumn("a", F.expr("g % size(words)"))
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    repeated = F.expr(
        "array_join(transform(words, (w, i) -> if(i < a, w, words[cast(a + (i - a) % p as int)])), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("words").isNull(), F.col("text")).otherwise(repeated).alias("text"))


def op12_query(documents: DataFrame) -> DataFrame:
    found = find_runs(planted_periods(documents)).withColumn("most", most_repeated())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    said = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"most.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("most.length * 1000 div most.period").alias("exponent_milli"),
        F.sha2(said.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_query(table(spark, sf_dir, "documents"))


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Rows after the damage the contract names, and the condition for those that are lost."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *part).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit(""))
        .when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        kind.alias("kind"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("again"),
    )
    return rows, F.col("kind") == 0


def op13_query(conversations: DataFrame) -> DataFrame:
    return report(repair_conversations(*damaged(conversations)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_query(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_decontamination,
        op3_simhash,
        op4_licenses,
        op5_exact_dedup,
        op6_secrets,
        op7_language_model,
        op8_language_id,
        op9_warc,
        op10_url_rules,
        op11_window_packing,
        op12_periodic_runs,
        op13_conversation_repair,
    )
}
