"""Remove lines that stand on many sites, all but their first occurrence.

Per line hash, a HyperLogLog sketch of the sites is merged by aggregation. A line far above the
threshold is boilerplate at once, one far below it is not; lines whose estimate lies within the
sketch's error of the threshold get an exact count of their distinct sites. Of a boilerplate line the
occurrence with the smallest (document, position) stays, so no text is lost from the corpus.

Scale: lines are shuffled as 16-byte hashes. Sketches combine before the shuffle, so a line on a
third of all documents sends one sketch per task. Both sides of the join that finds the occurrences
to be removed are shuffled, so adaptive execution can split the rows of a hot line.

Defined results: lines are split at line feeds and compared after each run of white space became one
space, without space at the ends. Blank lines, and lines of fewer than ``min_words`` words, are never removed. Null
text has no lines and stays null; a text whose lines all go becomes empty. A null site is one site.
Null ids come before others. Rows that agree in id and text are one document and keep the same lines.
All columns are returned, the text changed; ``lines_removed`` is added (under another name if taken).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import SPACE, fresh
from salesloom.operators.staging import stage

#: Distinct sites that make a line boilerplate, and the words it must have: every line that is not blank counts.
MIN_SITES = 3
MIN_WORDS = 1
#: Sketch size (log 2 of its slots), and how many standard errors count as near the threshold.
LOG_SLOTS = 12
ERRORS = 4


def line_keys(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_words: int) -> DataFrame:
    """One row per line that counts: doc_id, version (of the text), pos, key and site."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("version"),
        F.coalesce(F.concat(F.lit("="), F.col(site_col).cast("string")), F.lit("~")).alias("site"),
        F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"),
    )
    plain = F.trim(F.regexp_replace("line", SPACE, " "))
    words = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1
    return lines.where((words >= min_words) & (plain != "")).select(
        "doc_id", "version", "pos", F.unhex(F.md5(plain.cast("binary"))).alias("key"), "site"
    )


def boilerplate(keys: DataFrame, min_sites: int) -> DataFrame:
    """(key, first occurrence) of the lines on at least ``min_sites`` distinct sites."""
    spread = stage(
        keys.groupBy("key")
        .agg(
            F.hll_sketch_agg("site", LOG_SLOTS).alias("sites"),
            F.count(F.lit(1)).alias("n"),
            F.min(F.struct("doc_id", "version", "pos")).alias("first"),
        )
        .where(F.col("n") >= min_sites)  # fewer occurrences cannot be on so many sites
        .select("key", "first", F.hll_sketch_estimate("sites").alias("estimate")),
        "line_spread",
    )
    error = max(1.0, ERRORS * 1.04 / (1 << LOG_SLOTS) ** 0.5 * min_sites)
    near = F.abs(F.col("estimate") - min_sites) <= error
    counted = (
        keys.join(spread.where(near).select("key"), "key", "left_semi")
        .groupBy("key", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("exact"))
        .where(F.col("exact") >= min_sites)
    )
    close = spread.where(near).join(counted, "key").select("key", "first")
    return spread.where(~near & (F.col("estimate") > min_sites)).select("key", "first").unionAll(close)


def remove_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    min_sites: int = MIN_SITES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs`` without repeated cross-site lines, and how many lines each lost."""
    keys = stage(line_keys(docs, id_col, text_col, site_col, min_words), "line_keys")
    common = stage(boilerplate(keys, min_sites), "boilerplate")
    gone = (
        keys.join(common, "key")
        .where(~F.struct("doc_id", "version", "pos").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "version")
        .agg(F.collect_set("pos").alias("gone"))
    )
    left, right = docs.alias("d"), gone.alias("g")
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("g.doc_id")) & F.xxhash64(f"d.{text_col}").eqNullSafe(
        F.col("g.version")
    )
    kept = F.filter(
        F.split(F.col(f"d.{text_col}"), "\n", -1), lambda _, i: ~F.array_contains(F.col("g.gone"), i)
    )
    changed = F.when(F.col("g.gone").isNull(), F.col(f"d.{text_col}")).otherwise(F.array_join(kept, "\n"))
    return left.join(right, same, "left").select(
        *[changed.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns],
        F.coalesce(F.size("g.gone"), F.lit(0)).alias(fresh(docs, "lines_removed")),
    )
