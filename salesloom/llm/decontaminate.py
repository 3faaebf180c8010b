"""Benchmark decontamination by a positional inverted index of the training tokens.

1. Every document gets a row number and is dealt to a bucket by it. In its bucket it becomes postings
   (term, row, position), stored sorted by term: a table bucketed by row, so a later grouping or semi-join
   by row meets the postings where they are. One posting without a term closes each document; its
   position is the number of words, and it carries the document's id.
2. The tests are cut into phrases: every window of ten consecutive words, or a shorter text as a whole.
   Equal phrases are one. The index gives each test term's number of postings; a phrase with a term that
   the index lacks cannot occur.
3. The postings of a phrase's two rarest terms, each less the term's offset, are intersected by counting
   (row, phrase, start). What is left is met with the postings of the phrase's other terms in those rows
   only. A start at which all terms are found is an exact match.
4. For matches within a distance, the lists of a phrase's rarest term and of its others are met by blocks
   of positions, and the spans around each rarest term are counted.

Scale: a text moves once, when its bucket is built. Searching reads the columns of the index, with lists
of test terms that Spark broadcasts by their stored size or else meets by shuffle; after that only rows
with candidates move. Frequent words cost one scan each time, never a list. Buckets grow in number with
the bytes of text up to 32,768, then in size; sorting in a bucket spills.

Recovery: the index, the phrases and the matches are stored in the shared folder, so a lost executor costs
one step. An index that stopped half-way is not read; it is built anew at another path.

Defined results: words are runs of digits, letters a-z and non-ASCII characters, A-Z in lower case. Null
and empty texts have no words. Rows that repeat an id, null ids included, are documents of their own.
Items that share an id are one item that has the phrases of all their texts; a null id is written ``null``.
Items without words have no phrase. With an empty table of documents nothing is returned, with an empty one
of items nothing is hit. Other columns are ignored, whatever their names. Terms are compared as 64-bit hashes.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salesloom.llm.common import ascii_lower, text_of
from salesloom.operators.staging import stage, staged_path
from salesloom.sources import files

#: Words of a phrase.
WINDOW = 10
#: What parts words: ASCII but for digits and letters. They are named one by one, as Java looks single characters of a
#: class up in a bit set but tries its ranges in turn.
BETWEEN = "".join(f"\\x{c:02X}" for c in range(128) if not chr(c).isalnum())
#: A word in the text, before A-Z are put in lower case.
TOKEN = f"[^{BETWEEN}]+"
#: How many of a phrase's lists are intersected at once, the rarest.
RAREST = 2
#: Bytes of text that make a bucket, until there are so many buckets.
BUCKET_BYTES, MAX_BUCKETS = 16 << 20, 32768


def _lowered(word: Column) -> Column:
    """A-Z in lower case; the fast way where a word is ASCII altogether."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(ascii_lower(word))


def _tokens(text_col: str) -> Column:
    return F.regexp_extract_all(text_of(text_col), F.lit(TOKEN), F.lit(0))


def build_index(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Store the postings of all documents under ``path``; returns the table's name."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(8, math.ceil(size / BUCKET_BYTES)))
    name = f"postings_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    id_type = docs.schema[id_col].dataType.simpleString()
    spark.sql(
        f"CREATE TABLE {name} (term BIGINT, row BIGINT, pos INT, doc_id {id_type}) USING parquet "
        f"CLUSTERED BY (row) SORTED BY (term) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    ).repartition(buckets, "row")
    closed = F.concat(_tokens("text"), F.array(F.lit(None).cast("string")))
    words = rows.select("row", "doc_id", F.posexplode(closed).alias("pos", "word"))
    ended = F.col("word").isNull()
    words.select(
        F.when(~ended, F.xxhash64(_lowered(F.col("word")))).alias("term"),
        "row",
        "pos",
        F.when(ended, F.col("doc_id")).alias("doc_id"),
    ).write.insertInto(name)
    spark.catalog.refreshTable(name)
    return name


def drop_index(spark: SparkSession, index: str, path: str) -> None:
    """Remove an index and its files."""
    spark.sql(f"DROP TABLE IF EXISTS {index}")
    files.remove(spark, path)


def phrases_of(tests: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW):
    """The tests' distinct phrases (phrase, terms), and the items that have them (phrase, item)."""
    words = tests.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
        F.transform(_tokens(text_col), lambda w: F.xxhash64(_lowered(w))).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    cut = words.select("item", "words", F.explode(starts).alias("at"))
    cut = stage(cut.select("item", F.slice("words", F.col("at"), window).alias("terms")).distinct(), "item_phrases")
    phrases = stage(
        cut.select("terms").distinct().withColumn("phrase", F.monotonically_increasing_id()), "phrases"
    )
    return phrases, cut.join(phrases, "terms").select("phrase", "item")


def _ranked(postings: DataFrame, phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(phrase, at, term, size, place) of phrases whose terms all occur, from the rarest term on; and the
    test terms that occur, stored with their counts, so that Spark knows how few they are."""
    terms = phrases.select("phrase", F.size("terms").alias("size"), F.posexplode("terms").alias("at", "term"))
    known = stage(terms.select("term").distinct(), "test_terms")  # stored, so that its size is known
    counts = stage(postings.join(known, "term", "left_semi").groupBy("term").count(), "term_postings")
    rarest = Window.partitionBy("phrase").orderBy("count", "at")
    found = terms.join(counts, "term").withColumn("found", F.count(F.lit(1)).over(Window.partitionBy("phrase")))
    placed = found.where("found = size").withColumn("place", F.row_number().over(rarest))
    return stage(placed.select("phrase", "at", "term", "size", "place"), "ranked_terms"), counts.select("term")


def _of_rows(postings: DataFrame, terms: DataFrame, rows: DataFrame) -> DataFrame:
    """Postings of the test terms in some rows; the rows, a few bytes each, come to their buckets."""
    wanted = rows.select("row").distinct().hint("shuffle_hash")
    mine = postings.where("term IS NOT NULL").join(wanted, "row", "left_semi")
    return mine.join(terms, "term", "left_semi").select("row", "term", "pos")


def exact_matches(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """(row, phrase, start, size) of every place where a phrase stands word by word."""
    ranked, terms = _ranked(postings, phrases)
    lists = ranked.where(F.col("place") <= RAREST)
    first = (
        postings.join(lists, "term")
        .select("row", "phrase", (F.col("pos") - F.col("at")).alias("start"), "size")
        .groupBy("row", "phrase", "start")
        .agg(F.count(F.lit(1)).alias("met"), F.min("size").alias("size"))
        .where(F.col("met") == F.least(F.col("size"), F.lit(RAREST)))
    )
    first = stage(first.select("row", "phrase", "start", "size"), "phrase_candidates")
    due = first.join(ranked.select("phrase", "at", "term"), "phrase").withColumn("pos", F.col("start") + F.col("at"))
    met = due.join(_of_rows(postings, terms, first), ["row", "pos", "term"])
    return (
        met.groupBy("row", "phrase", "start")
        .agg(F.count(F.lit(1)).alias("met"), F.min("size").alias("size"))
        .where("met = size")
        .select("row", "phrase", "start", "size")
    )


def near_matches(postings: DataFrame, phrases: DataFrame, width: int) -> DataFrame:
    """(row, phrase, start) of spans of ``width`` words that hold all of a phrase's distinct terms, in any order.

    A span starts at one of those terms. Positions meet by blocks of ``width``, so a posting is compared
    with those of its own and the neighbouring blocks.
    """
    single = stage(phrases.select("phrase", F.array_distinct("terms").alias("terms")), "phrase_terms")
    ranked, terms = _ranked(postings, single)
    block = F.floor(F.col("pos") / width).cast("int")
    around = F.explode(F.array(block - 1, block, block + 1)).alias("block")
    anchors = (
        postings.join(ranked.where("place = 1").select("term", "phrase", "size"), "term")
        .select("row", "phrase", F.col("pos").alias("anchor"), "size", around)
    )
    second = postings.join(ranked.where("place = 2").select("term", "phrase"), "term").select("row", "phrase", "pos", block.alias("block"))
    within = F.abs(F.col("pos") - F.col("anchor")) < width
    paired = anchors.join(second, ["row", "phrase", "block"]).where(within).select("row", "phrase", "anchor", "size")
    lone = anchors.where("size = 1").select("row", "phrase", "anchor", "size")
    first = stage(paired.unionAll(lone).distinct(), "near_candidates")
    due = first.select("row", "phrase", "anchor", "size", F.explode(F.array(*[F.floor(F.col("anchor") / width).cast("int") + d for d in (-1, 0, 1)])).alias("block"))
    due = due.join(ranked.select("phrase", "term"), "phrase")
    listed = _of_rows(postings, terms, first).withColumn("block", block)
    met = due.join(listed, ["row", "term", "block"]).where(within)
    # a posting lies in the spans that start at most width - 1 words before it and hold the anchor
    starts = F.sequence(F.greatest("pos", "anchor") - (width - 1), F.least("pos", "anchor"))
    spans = met.select("row", "phrase", "size", "term", "pos", F.explode(starts).alias("start"))
    return (
        spans.groupBy("row", "phrase", "start")
        .agg(F.size(F.collect_set("term")).alias("met"), F.min("pos").alias("least"), F.min("size").alias("size"))
        .where("met = size AND least = start")
        .select("row", "phrase", "start")
    )


def documents_hit(postings: DataFrame, matches: DataFrame, members: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (ids joined by commas), contaminated."""
    matches = stage(matches.select("row", "phrase", "start", (F.col("start") + F.col("size")).alias("stop")), "phrase_matches")
    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("start", F.coalesce(F.max("stop").over(before), F.col("start")))
    new = matches.withColumn("new", F.greatest(F.col("stop") - reached, F.lit(0)))
    hit = new.groupBy("row").agg(F.sum("new").alias("n_hit"))
    items = matches.select("row", "phrase").distinct().join(members, "phrase").select("row", "item").distinct()
    items = items.groupBy("row").agg(F.count(F.lit(1)).alias("n_items"), F.sort_array(F.collect_list("item")).alias("items"))
    documents = postings.where("term IS NULL").select("row", "doc_id", F.col("pos").cast("long").alias("n_words"))
    return documents.join(hit.join(items, "row"), "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def decontaminate(docs: DataFrame, tests: DataFrame, window: int = WINDOW) -> DataFrame:
    """What of each document stands in the tests; the index is removed when the answer is stored."""
    spark = docs.sparkSession
    path = staged_path(spark, "postings")
    index = build_index(docs, path)
    phrases, members = phrases_of(tests, window=window)
    postings = spark.table(index)
    found = stage(documents_hit(postings, exact_matches(postings, phrases), members), "decontaminated")
    drop_index(spark, index, path)
    return found
