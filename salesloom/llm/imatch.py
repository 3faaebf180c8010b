"""I-Match fingerprints over randomised lexicon subsets.

The lexicon holds the terms whose document frequency lies in a band: rare enough to tell texts
apart, frequent enough to be bounded in number. It is split at random into 2^j subsets, for every
level j. Of a text with T distinct lexicon terms the level with one or two terms per subset is
used, and the next finer one: in each of the first ``SUBSETS`` subsets the text's terms are
sorted and hashed. Two fingerprints are compared at a level both have; with q the share of equal
subsets and e the share that is empty in both, their likeness is 1 - ln q / ln e: 1 for the same terms,
0 when no more subsets agree than are empty.

Everything is DataFrame code. Texts are shuffled once, into buckets of neighbouring ids whose bounds
are percentiles of the ids; the first document of a bucket is also a guest at the end of the one before, so
that each document meets the next one without a join. All that follows is grouped by bucket, as the
data lie. The lexicon has at most (mean distinct terms per document) / ``RARE`` rows, whatever the
corpus; it is broadcast after a check of its rows, and joined by shuffle beyond ``BROADCAST_ROWS``.

Defined results: terms are words, A-Z in lower case. A null text counts as empty. A text without
lexicon terms has the hash of the whole text for a fingerprint, like only to itself. Null ids come first;
rows that share an id are ordered by text. A lone document is its own next one. No rows give no
rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import SPACE, ascii_lower, text_of
from salesloom.operators.staging import stage

#: The band of document frequencies, as shares of all documents.
RARE = 1 / 512
FREQUENT = 1 / 16
#: Subsets that are hashed per level.
SUBSETS = 32
#: Lexicon rows up to which it is broadcast (some 40 bytes each).
BROADCAST_ROWS = 1_000_000


def terms_of(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.filter(F.split(ascii_lower(text), SPACE, -1), lambda w: w != ""))


def lexicon_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, draw) of the terms in the band, counted over all documents."""
    # the outer form, as for the other Spark would first ask for the size of the array, and make it twice
    terms = docs.select(F.explode_outer(terms_of(text_of(text_col))).alias("term"))
    counted = terms.where("term IS NOT NULL").groupBy("term")
    n = docs.count()
    draw = F.conv(F.substring(F.md5(F.col("term").cast("binary")), 1, 8), 16, 10).cast("long")
    return (
        counted.agg(F.count(F.lit(1)).alias("df"))
        .where((F.col("df") >= RARE * n) & (F.col("df") <= FREQUENT * n) & (F.col("df") > 1))
        .select("term", draw.alias("draw"))
    )


def _bounds(docs: DataFrame, n: int) -> list[int]:
    """About ``n`` ids that cut the documents into equal parts, the least id first."""
    shares = [i / n for i in range(n)]
    row = docs.agg(F.min("doc_id").alias("least"), F.percentile_approx("doc_id", shares, 10 * n).alias("cuts")).first()
    return sorted({row["least"], *(row["cuts"] or [])} - {None}) or [0]


def _bucket(bounds: list[int], doc_id: Column) -> Column:
    """Index of the last bound up to ``doc_id`` (0 below all), by two short scans."""
    width = max(1, int(len(bounds) ** 0.5))
    rows = [bounds[at : at + width] for at in range(0, len(bounds), width)]

    def up_to(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= doc_id))

    table = F.array(*[F.array(*[F.lit(b).cast("long") for b in r]) for r in rows])
    heads = F.array(*[F.lit(r[0]).cast("long") for r in rows])
    row = F.greatest(up_to(heads), F.lit(1)) - 1
    return F.when(doc_id.isNull(), F.lit(0)).otherwise(
        F.greatest(row * width + up_to(F.get(table, row)) - 1, F.lit(0))
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, place, guest, doc_id, text, next_text); guests stand for the next bucket's first rows."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    spark = docs.sparkSession
    # several buckets a partition, so that chance fills partitions evenly
    bounds = _bounds(texts, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    last = len(bounds) - 1
    own = _bucket(bounds, F.col("doc_id"))
    firsts = F.array(*[F.lit(b).cast("long") for b in bounds])
    opens = F.when(F.col("doc_id").isNull(), F.lit(True)).otherwise(F.get(firsts, F.col("own")) == F.col("doc_id"))
    before = F.when(F.col("own") == 0, F.lit(last)).otherwise(F.col("own") - 1)
    seats = F.array(
        F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest")),
        F.when(opens, F.struct(before.alias("bucket"), F.lit(True).alias("guest"))),
    )
    along = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return (
        texts.withColumn("own", own)
        .withColumn("seat", F.explode(F.filter(seats, lambda s: s.isNotNull())))
        .select("seat.bucket", "seat.guest", "doc_id", "text")
        .withColumn("next_text", F.lead("text").over(along))
        .withColumn("place", F.row_number().over(along))
    )


# Expressions below are columns of their own, level by level, and each is used at least twice: Spark
# then computes it once and does not move it into the loops that use it.


def _level(terms: Column) -> Column:
    """The level with one or two terms per subset; null without terms."""
    return F.when(F.size(terms) > 0, F.floor(F.log2(F.size(terms))).cast("int"))


def _drawn(terms: Column, level: Column) -> Column:
    """The terms that fall into the first subsets of a level, each after its subset's number, sorted."""
    cells = F.pow(F.lit(2.0), level).cast("long")
    inside = F.filter(terms, lambda t: t["draw"] % cells < SUBSETS)
    return F.sort_array(
        F.transform(inside, lambda t: F.struct((t["draw"] % cells).alias("cell"), t["term"].alias("term")))
    )


def _hashes(drawn: Column, level: Column) -> Column:
    """Hash of the sorted terms in each of the first subsets of a level, '' where there are none."""
    n = F.least(F.pow(F.lit(2.0), level), F.lit(float(SUBSETS))).cast("int")

    def joined(cell: Column) -> Column:
        inside = F.filter(drawn, lambda t: t["cell"] == cell)
        return F.array_join(F.transform(inside, lambda t: t["term"]), " ")

    def hashed(text: Column) -> Column:
        return F.when(text == "", "").otherwise(F.substring(F.md5(text.cast("binary")), 1, 6))

    every = F.transform(F.sequence(F.lit(0), n - 1), joined)
    return (
        F.when(level.isNull(), None)
        .when(F.size(drawn) == 0, F.array_repeat(F.lit(""), n))
        .otherwise(F.transform(every, hashed))
    )


def _part(of: str, name: str) -> Column:
    return F.col(f"{of}_{name}")


def as_text(of: str) -> Column:
    """The fingerprint whose columns begin with ``of`` as one string."""
    return F.when(_part(of, "level").isNull(), F.concat(F.lit("-:"), _part(of, "whole"))).otherwise(
        F.concat_ws(
            ":",
            _part(of, "level").cast("string"),
            F.array_join(_part(of, "coarse"), ","),
            F.array_join(_part(of, "fine"), ","),
        )
    )


def likeness(a: str, b: str) -> Column:
    """How like two fingerprints are, 0 to 1."""
    p, q = _part(a, "level"), _part(b, "level")
    here = F.when(p < q, _part(a, "fine")).otherwise(_part(a, "coarse"))
    there = F.when(p > q, _part(b, "fine")).otherwise(_part(b, "coarse"))
    pairs = F.zip_with(here, there, lambda x, y: F.when(x != y, 0).when(x == "", 1).otherwise(2))
    # (subsets, equal ones, those empty in both) in one pass
    counts = F.aggregate(
        pairs,
        F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("equal"), F.lit(0.0).alias("empty")),
        lambda c, x: F.struct(
            (c["n"] + 1).alias("n"),
            (c["equal"] + (x > 0).cast("double")).alias("equal"),
            (c["empty"] + (x == 1).cast("double")).alias("empty"),
        ),
        lambda c: F.struct(
            (c["equal"] / c["n"]).alias("equal"),
            (F.greatest(c["empty"] / c["n"], F.lit(0.5) / c["n"])).alias("empty"),
        ),
    )

    def of(c: Column) -> Column:
        return (
            F.when(c["equal"] == 1, F.lit(1.0))
            .when(c["equal"] <= c["empty"], F.lit(0.0))
            .otherwise(1 - F.log(c["equal"]) / F.log(c["empty"]))
        )

    found = (
        F.when(p.isNull() | q.isNull(), (_part(a, "whole") == _part(b, "whole")).cast("double"))
        .when(F.abs(p - q) > 1, F.lit(0.0))
        .otherwise(F.element_at(F.transform(F.array(counts), of), 1))
    )
    return F.coalesce(F.round(found, 6), F.lit(0.0))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The edited text is the document's with its last quarter replaced by the beginning of the next.
    """
    lexicon = stage(lexicon_of(docs, text_col), "imatch_lexicon")
    if lexicon.count() <= BROADCAST_ROWS:
        lexicon = F.broadcast(lexicon)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cast(floor(length(text) / 4) AS INT))"), F.substring("next_text", F.lit(1), quarter))
    texts = with_next(docs, id_col, text_col).withColumn("edited", F.coalesce(edited, F.lit("")))
    # Digests are taken before texts are cut into terms: after that, they would be taken for every term.
    # What is known of a document travels on one marker row, so the rows of its terms are short.
    info = F.struct(
        "guest",
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.md5(F.col("text").cast("binary")).alias("own_whole"),
        F.md5(F.col("edited").cast("binary")).alias("edited_whole"),
    )
    nothing = F.lit(None).cast(
        "struct<guest:boolean,doc_id:bigint,n_chars:bigint,edited_sha256:string,own_whole:string,edited_whole:string>"
    )

    def tagged(text: str, kind: int) -> Column:
        return F.transform(
            terms_of(F.col(text)),
            lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("term"), nothing.alias("info")),
        )

    marker = F.struct(F.lit(2).alias("kind"), F.lit("").alias("term"), F.col("info").alias("info"))
    rows = texts.withColumn("info", info).select(
        "bucket", "place", F.concat(F.array(marker), tagged("text", 0), tagged("edited", 1)).alias("terms")
    )
    # no array is empty, as each has its marker
    rows = rows.select("bucket", "place", F.explode_outer("terms").alias("at")).select("bucket", "place", "at.*")
    known = rows.join(lexicon, "term", "left").where("draw IS NOT NULL OR kind = 2")

    def terms(kind: int) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("term", "draw"))))

    grouped = known.groupBy("bucket", "place").agg(
        F.first("info", ignorenulls=True).alias("info"), terms(0).alias("own_terms"), terms(1).alias("edited_terms")
    )
    printed = grouped.select("bucket", "place", "info.*", "own_terms", "edited_terms")
    for step in (
        lambda of: {f"{of}_level": _level(_part(of, "terms"))},
        lambda of: {
            f"{of}_drawn": _drawn(_part(of, "terms"), _part(of, "level")),
            f"{of}_finer": _drawn(_part(of, "terms"), _part(of, "level") + 1),
        },
        lambda of: {
            f"{of}_coarse": _hashes(_part(of, "drawn"), _part(of, "level")),
            f"{of}_fine": _hashes(_part(of, "finer"), _part(of, "level") + 1),
        },
    ):
        printed = printed.withColumns(step("own") | step("edited"))
    along = Window.partitionBy("bucket").orderBy("place")
    parts = ("level", "coarse", "fine", "whole")
    printed = printed.withColumns({f"next_{x}": F.lead(f"own_{x}").over(along) for x in parts})
    return printed.where(~F.col("guest")).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text("own").alias("fingerprint"),
        as_text("edited").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"),
        likeness("own", "next").alias("near_next"),
    )
