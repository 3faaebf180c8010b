"""Near-duplicate documents by SetSketch registers: band, estimate jointly, verify on full sets.

1. Each text becomes a digest of its word sequence and the registers of its shingle set. Texts with the
   same words are one class; only one text of a class goes on.
2. Five registers make a band; classes that agree in one of 24 bands are drawn to the band's least
   class. At a similarity of 0.85 a pair misses all bands with a chance below 1e-5. Below 0.85 four
   registers make one of 30 bands; at 0.8 a pair misses them with a chance below 1e-6.
3. Connected components of these draws are groups of candidates. A group is cut into blocks of 256 and
   every pair of blocks is compared in a task of its own, so a hot group is spread and its pairs never
   leave the task: sizes and the joint likelihood of the registers rule pairs out (five standard errors
   below the threshold), the others are verified on their whole shingle sets. Only links that
   connect something new are emitted, fewer than there are classes in the two blocks.
4. Connected components of the links; the smallest id of each stays.

Scale: texts are read twice; the second time they are shuffled by id and a hash of the text to meet the
classes that have candidates at all, so rows without an id or with the same one meet their own class
only. What goes into blocks is 8 bytes per shingle of those classes. Sums and minima
are combined before shuffles and all joins are between shuffled sides, which adaptive execution
can split. A group of n classes costs n * n / 512 comparisons of blocks' members, spread over tasks.

Defined results: words are runs other than white space, A-Z in lower case. Null and empty texts have no
shingles, link with nothing and stay. Equal shingle sets of different texts link. Ids that are null
never name a component unless all of it is null. Rows that repeat an id keep a verdict each.
Shingles are compared as 64-bit hashes. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ship
from salesloom.llm.components import components
from salesloom.llm.shingles import REGISTERS, joint_estimate, registers, shingle_sets
from salesloom.operators.staging import stage

#: Registers per band from a similarity of 85 percent on and below it.
BAND, LOOSE_BAND = 5, 4
#: Classes per block, and the least similarity in percent.
BLOCK = 256
PERCENT = 80

_SKETCHED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("class", pa.binary()),
        ("n_shingles", pa.int64()),
        ("registers", pa.binary()),
    ]
)
_SETS = pa.schema(
    [
        ("class", pa.binary()),
        ("root", pa.binary()),
        ("blocks", pa.int32()),
        ("own", pa.int32()),
        ("shingles", pa.binary()),
        ("registers", pa.binary()),
    ]
)
_LINKS = pa.schema([("u", pa.binary()), ("v", pa.binary())])


def _bytes_of(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in texts.cast(pa.binary()).to_pylist()]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """text, doc_id and a hash of the text."""
    text = F.col(text_col).cast("string")
    return docs.select(text.alias("text"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_hash, class, n_shingles and registers (class and registers null without words)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                known = zip(*(c.to_pylist() for c in part.columns[1:]))
                rows = [
                    (*row, digest, len(found), registers(found).tobytes() if digest else None)
                    for row, (found, digest) in zip(known, shingle_sets(_bytes_of(part.column(0))))
                ]
                yield _batch(rows, _SKETCHED)

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, text_hash long, class binary, n_shingles long, registers binary"
    )


def candidate_groups(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(class, root) of the classes that share a band with another one, directly or by others."""
    band = BAND if percent >= 85 else LOOSE_BAND
    n = REGISTERS // band
    bands = classes.select(
        "class",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(0), F.lit(n - 1)),
                lambda k: F.substring("registers", k * (2 * band) + 1, F.lit(2 * band)),
            )
        ).alias("band", "value"),
    )
    shared = (
        bands.groupBy("band", "value")
        .agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    draws = bands.join(shared, ["band", "value"]).where("class != least")
    return components(draws.select(F.col("class").alias("u"), F.col("least").alias("v")))


def _sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add shingles and registers to ``wanted`` (class, one of its rows, root, blocks, own), read from the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                known = zip(*(c.to_pylist() for c in part.columns[1:]))
                rows = []
                for want, (found, digest) in zip(known, shingle_sets(_bytes_of(part.column(0)))):
                    # copies under one id follow each other: one of them goes on
                    if want[0] == digest != last:
                        rows.append((*want, found.tobytes(), registers(found).tobytes()))
                        last = digest
                yield _batch(rows, _SETS)

    texts = _texts(docs, id_col, text_col)
    # the same join at every size: what is wanted grows with the texts
    wanted = wanted.hint("merge")
    same_row = texts["doc_id"].eqNullSafe(wanted["doc_id"]) & (texts["text_hash"] == wanted["text_hash"])
    met = texts.join(wanted, same_row)
    return met.select("text", "class", "root", "blocks", "own").mapInArrow(
        run, "class binary, root binary, blocks int, own int, shingles binary, registers binary"
    )


class _Forest:
    """Which members of a block pair are connected already."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> None:
        self.parent[self.find(a)] = self.find(b)


def verified_links(
    names: list[bytes], sets: list[np.ndarray], sketch: np.ndarray, side: np.ndarray, percent: int
) -> list[tuple[bytes, bytes]]:
    """Links among members of one block (all of side 0) or between two, no more than connect them."""
    if (side == side[0]).all():
        left, right = np.triu_indices(len(names), 1)
    else:
        left, right = (x.ravel() for x in np.meshgrid(np.flatnonzero(side == 0), np.flatnonzero(side == 1)))
    sizes = np.array([len(s) for s in sets], np.float64)
    n, m = sizes[left], sizes[right]
    fits = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    left, right, n, m = left[fits], right[fits], n[fits], m[fits]
    if not len(left):
        return []
    larger, smaller = np.empty(len(left)), np.empty(len(left))
    for at in range(0, len(left), 8192):
        a, b = sketch[left[at : at + 8192]], sketch[right[at : at + 8192]]
        larger[at : at + 8192], smaller[at : at + 8192] = (a > b).sum(1), (a < b).sum(1)
    likely = joint_estimate(larger, smaller, n, m)
    bound = percent / 100
    order = np.argsort(-likely, kind="stable")
    order = order[likely[order] >= bound - 5 * (bound * (1 - bound) / REGISTERS) ** 0.5]
    forest, links = _Forest(len(names)), []
    for a, b in zip(left[order].tolist(), right[order].tolist()):
        if forest.find(a) != forest.find(b):
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                forest.join(a, b)
                links.append((names[a], names[b]))
    return links


def _block_links(blocks: DataFrame, percent: int) -> DataFrame:
    """Links of every pair of blocks; rows come sorted by the pair, so a task streams over them."""

    def links(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        seen: dict[bytes, tuple] = {}
        for _, side, name, shingles, sketch in rows:
            seen.setdefault(name, (side, shingles, sketch))
        return verified_links(
            list(seen),
            [np.frombuffer(s, np.uint64) for _, s, _ in seen.values()],
            np.array([np.frombuffer(k, "<u2") for _, _, k in seen.values()]).reshape(len(seen), -1),
            np.array([s for s, _, _ in seen.values()]),
            percent,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            found = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    found += links(held)
                    held = []
                held.append(row)
            yield _batch(found, _LINKS)
        yield _batch(links(held) if held else [], _LINKS)

    dealt = blocks.repartition("pair").sortWithinPartitions("pair")
    return dealt.select("pair", "side", "class", "shingles", "registers").mapInArrow(run, "u binary, v binary")


def links_of(docs: DataFrame, drawn: DataFrame, classes: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Verified links (u, v) between classes; those left out join what other links join."""
    groups = drawn.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    placed = (
        drawn.join(groups, "root")
        .withColumnRenamed("node", "class")
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    )
    wanted = classes.join(placed, "class").select("class", "doc_id", "text_hash", "root", "blocks", "own")
    wanted = stage(wanted, "near_wanted")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocks = (
        _sets_of(docs, wanted, id_col, text_col)
        .withColumn("other", other)
        .select(
            F.concat_ws("/", F.hex("root"), F.least("own", "other"), F.greatest("own", "other")).alias("pair"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
            "class",
            "shingles",
            "registers",
        )
    )
    return _block_links(blocks, percent)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (its smallest id) and kept."""
    sketched = stage(sketches(docs, id_col, text_col), "near_sketches")
    row = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    classes = stage(
        sketched.where("class IS NOT NULL")
        .groupBy("class")
        .agg(F.min(row).alias("row"), F.min("registers").alias("registers"))
        .select("class", "row.doc_id", "row.text_hash", "registers"),
        "near_classes",
    )
    drawn = stage(candidate_groups(classes, percent), "near_candidates")
    links = stage(links_of(docs, drawn, classes.drop("registers"), id_col, text_col, percent), "near_links")
    linked = components(links).withColumnRenamed("node", "class")
    named = classes.select("class", "doc_id").join(linked, "class", "left")
    named = named.withColumn("root", F.coalesce("root", "class"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    verdicts = stage(named.join(least, "root").select("class", "component_id"), "near_verdicts")
    worded = sketched.where("class IS NOT NULL").join(verdicts, "class")
    wordless = sketched.where("class IS NULL").withColumn("component_id", F.col("doc_id"))
    rows = worded.select("doc_id", "n_shingles", "component_id").unionAll(
        wordless.select("doc_id", "n_shingles", "component_id")
    )
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
