"""One query per operator over the whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm import (
    chat_tree,
    decontaminate,
    exact_dedup,
    imatch,
    line_dedup,
    masked_lm,
    mixing,
    near_dedup,
    packing,
    reversed_search,
    spelling,
    toxicity,
    url_filter,
)
from salesloom.llm.common import ascii_lower, read, text_of

Query = Callable[[SparkSession, str], DataFrame]


#: Fixed rules of the URL query: (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(read(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "lines_removed")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    urls = read(spark, sf_dir, "pages").select(
        "page_id", url_filter.host_of(url).alias("host"), url_filter.path_of(url).alias("path")
    )
    return url_filter.judge(urls, URL_RULES, url_filter.rule_labels(urls, URL_RULES))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.tag(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC).cast("int").alias("predicted"),
        "n_toxic",
        "spans",
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(read(spark, sf_dir, "documents"))


def op6_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return masked_lm.score(docs, masked_lm.train(docs))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.dedup(read(spark, sf_dir, "documents"), percent=85)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"), exact_dedup.new_index_path(spark))


def op9_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    columns = ["conv_id", "turn", "role", "text"]
    tricky = "\\### Assistant: </turn> ok"
    rows = (
        read(spark, sf_dir, "conversations")
        .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
        .unionByName(
            spark.createDataFrame(
                [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
            ).select(*columns)
        )
    )
    trees, members = chat_tree.format_conversations(rows, tokenizer)
    return members.join(chat_tree.read_back(trees, tokenizer), "leaf").drop("leaf")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id",
        "start",
        F.expr("CAST(octet_length(ids) div 4 AS BIGINT)").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.col("items").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def misspelt_words(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """(word, n): runs of letters, of which one in ``every``, by a checksum, loses a letter; at least two occurrences.

    A null id is written ``null`` in the checksum. A run of ``least`` letters that loses one is no word.
    """
    run = F.regexp_extract_all(text_of(), F.lit("[A-Za-z\u00C0-\u00FF]{%d,}" % least), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), F.explode(run).alias("run"))
    ascii_only = F.octet_length("run") == F.char_length("run")
    lowered = F.when(ascii_only, F.lower("run")).otherwise(ascii_lower(F.col("run")))
    drawn = runs.select(lowered.alias("run"), F.crc32(F.concat("id", F.lit(":"), lowered)).alias("draw"))
    at = (F.col("draw") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(F.col("draw") % every == 0, shorter).otherwise(F.col("run"))
    found = drawn.select(word.alias("word")).where(F.char_length("word") >= least)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(misspelt_words(read(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_imatch": op5_imatch,
    "op6_masked_lm": op6_masked_lm,
    "op7_near_dedup": op7_near_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_chat_tree": op9_chat_tree,
    "op10_pack": op10_pack,
    "op11_decontaminate": op11_decontaminate,
    "op12_reversed_search": op12_reversed_search,
    "op13_spelling": op13_spelling,
}
