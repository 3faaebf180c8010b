"""Ranked lexical search reversed: the items are indexed and the documents stream past the index.

1. Items are dealt to blocks of a bounded number of terms (one block, unless there are very many items). A
   block's terms become an inverted index, term to (item, how often), which goes to every executor.
2. Documents are read once per block: each becomes its number of terms and the counts of those terms that
   the block knows. The corpus statistics are sums over these rows.
3. The counts stream through the index. A document's scores for all items come from one pass over the
   lists of its terms, and each item keeps a heap of its best documents. At its end a task sends its heaps,
   at most ``top`` rows an item, and these are merged in two steps.

Scale: texts are never shuffled, a row of the stored counts is a fraction of its text, a task's memory is
the index, a slice of documents and the heaps, whatever the number of documents. A term in every
document costs a longer list in its task, no shuffle. What the driver sees of the items is one block at a time.

Recovery: the counts and the merged ranks are stored in the shared folder; a lost task is run again.

Defined results: terms are runs of digits, letters and non-ASCII characters, A-Z in lower case. Null and
empty texts have no terms, do not count as documents and are in no answer. Each row of the items is an item
of its own, also if ids repeat; an item without terms has no answer. Rows that repeat a document's id
are documents of their own; equal scores go by ascending id, null ids last. With no documents there are no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import ship
from salesloom.operators.staging import stage

#: Answers per item, and term positions of the items that make a block.
TOP = 20
BLOCK_TERMS = 1 << 20
#: Entries (document, item) that are added up at once, and ways into which a first merge is split.
SLICE, WAYS = 1 << 21, 64

#: Bytes of a text: letters A-Z to lower case, what separates terms to a space, others as they are.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_COUNTED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())])
_BEST = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()), ("way", pa.int32())])


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(_FOLD).split()


class ItemIndex:
    """Inverted index of a block of items: per term the items that have it, and how often."""

    def __init__(self, texts: list[bytes]):
        self.names: dict[bytes, int] = {}
        found: dict[tuple[int, int], int] = {}
        for item, text in enumerate(texts):
            for term in terms_of(text):
                key = self.names.setdefault(term, len(self.names)), item
                found[key] = found.get(key, 0) + 1
        entries = np.array([(t, i, n) for (t, i), n in sorted(found.items())], np.int64).reshape(-1, 3)
        self.n_items = len(texts)
        self.items, self.repeats = entries[:, 1], entries[:, 2]
        self.starts = np.searchsorted(entries[:, 0], np.arange(len(self.names) + 1))


def weights(held: np.ndarray, n_docs: int) -> np.ndarray:
    """A term's weight by the documents that hold it."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64)


def contributions(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to a document's score, each time an item has it."""
    m = 100 - 25 + (25 * n * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def exact_sums(keys: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of 64-bit integers by key. Doubles add exactly in halves of 31 bits."""
    low = np.bincount(keys, weights=values & 0x7FFFFFFF, minlength=size)
    high = np.bincount(keys, weights=values >> 31, minlength=size)
    return (high.astype(np.int64) << 31) + low.astype(np.int64)


class Heaps:
    """The best documents of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top, self.heaps = top, [[] for _ in range(n_items)]
        self.least = np.zeros(n_items, np.int64)  # the score that a newcomer must reach

    def offer(self, ids: list, scores: np.ndarray) -> None:
        """Scores of documents (rows) for all items (columns)."""
        for row, item in zip(*np.nonzero((scores > 0) & (scores >= self.least))):
            id_, heap = ids[row], self.heaps[item]
            entry = (int(scores[row, item]), id_ is not None, -(id_ or 0))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[item] = heap[0][0]

    def rows(self) -> list[tuple]:
        """(item, doc_id, score)."""
        return [(i, -neg if known else None, score) for i, heap in enumerate(self.heaps) for score, known, neg in heap]


def count_terms(docs: DataFrame, index: ItemIndex, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (terms) and, of the terms that the index has, their numbers and counts; no row without terms."""
    names = docs.sparkSession.sparkContext.broadcast(index.names)
    width = max(len(index.names), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = names.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, numbers = [], []
                for text in part.column(1).cast(pa.binary()).to_pylist():
                    terms = terms_of(text or b"")
                    sizes.append(len(terms))
                    numbers.append(np.array([get(t, -1) for t in terms], np.int64))
                rows = np.repeat(np.arange(len(sizes)), sizes)
                numbers = np.concatenate([np.zeros(0, np.int64), *numbers])
                keys, counts = np.unique(rows[numbers >= 0] * width + numbers[numbers >= 0], return_counts=True)
                ends = np.searchsorted(keys, np.arange(len(sizes) + 1) * width).tolist()
                numbers, counts = (keys % width).astype("<i4"), counts.astype("<i4")
                out = [
                    (i, n, numbers[a:b].tobytes(), counts[a:b].tobytes())
                    for i, n, a, b in zip(part.column(0).to_pylist(), sizes, ends, ends[1:])
                    if n
                ]
                columns = zip(*out) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _COUNTED)], schema=_COUNTED)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, terms binary, counts binary"
    )


def documents_holding(counted: DataFrame, n_terms: int) -> np.ndarray:
    """The number of documents that hold each term of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms in batch.column(0).to_pylist():
                held[np.frombuffer(terms, "<i4")] += 1
        known = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(known, pa.int32()), pa.array(held[known])], ["term", "held"])

    found = counted.select("terms").mapInArrow(run, "term int, held long").groupBy("term").agg(F.sum("held").alias("held"))
    held = np.zeros(n_terms, np.int64)
    for row in found.collect():  # as many rows as a block has terms, at most
        held[row["term"]] = row["held"]
    return held


def best_documents(counted: DataFrame, index: ItemIndex, weight: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score, way): the heaps of every task."""
    sent = counted.sparkSession.sparkContext.broadcast((index, weight))

    def scores(sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        index, weight = sent.value
        rows = np.repeat(np.arange(len(sizes)), sizes)
        adds = contributions(weight[terms], tf, n[rows], n_docs, n_terms)
        lengths = index.starts[terms + 1] - index.starts[terms]
        ends = np.cumsum(lengths)
        entry = np.arange(ends[-1] if len(ends) else 0) + np.repeat(index.starts[terms] - (ends - lengths), lengths)
        keys = np.repeat(rows * index.n_items, lengths) + index.items[entry]
        values = np.repeat(adds, lengths) * index.repeats[entry]
        return exact_sums(keys, values, len(sizes) * index.n_items).reshape(len(sizes), index.n_items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, _ = sent.value
        heaps = Heaps(index.n_items, top)
        lists = np.diff(index.starts)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            n = np.array(batch.column(1).to_pylist(), np.int64)
            terms = [np.frombuffer(t, "<i4").astype(np.int64) for t in batch.column(2).to_pylist()]
            tf = [np.frombuffer(t, "<i4").astype(np.int64) for t in batch.column(3).to_pylist()]
            work = np.cumsum([index.n_items + int(lists[t].sum()) for t in terms])
            at = 0
            while at < len(ids):  # as many documents as fit a slice, one at least
                base = work[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(work, base + SLICE)))
                sizes = np.array([len(t) for t in terms[at:to]])
                found = scores(sizes, np.concatenate(terms[at:to]), np.concatenate(tf[at:to]), n[at:to])
                heaps.offer(ids[at:to], found)
                at = to
        rows, way = heaps.rows(), TaskContext.get().partitionId() % WAYS
        columns = [*zip(*rows)] if rows else [[]] * 3
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, _BEST)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([way] * len(rows), pa.int32())], schema=_BEST)

    return counted.mapInArrow(run, "item int, doc_id long, score long, way int")


def _ranked(best: DataFrame, keys: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``top`` documents."""
    spark = docs.sparkSession
    ship(spark)
    length = F.coalesce(F.octet_length(item_text_col), F.lit(0))
    dealt = stage(
        items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"), length.alias("length"))
        .withColumn("place", F.monotonically_increasing_id()),
        "search_items",
    )
    size = dealt.agg(F.sum("length")).first()[0] or 0
    n_blocks = max(1, math.ceil(size / 2 / block_terms))  # a term takes two bytes at least, with what parts it
    answers = None
    for block in range(n_blocks):
        mine = dealt.where(F.pmod(F.xxhash64("place"), F.lit(n_blocks)) == block)
        rows = mine.select("place", "text").orderBy("place").collect()
        index = ItemIndex([(r["text"] or "").encode() for r in rows])
        counted = stage(count_terms(docs, index, id_col, text_col), "term_counts")
        n_docs, n_terms = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        weight = weights(documents_holding(counted, len(index.names)), n_docs)
        best = best_documents(counted, index, weight, n_docs, n_terms or 0, top)
        merged = stage(_ranked(_ranked(best, ["item", "way"], top).drop("rank"), ["item"], top), "search_ranks")
        places = spark.createDataFrame([(i, r["place"]) for i, r in enumerate(rows)], "item int, place long")
        ranked = merged.join(places, "item").join(mine.select("place", "item_id"), "place")
        ranked = ranked.select("item_id", "rank", "doc_id", "score")
        answers = ranked if answers is None else answers.unionAll(ranked)
    return answers
