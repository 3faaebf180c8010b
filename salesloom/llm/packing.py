"""Pack documents into windows with the online sum-of-squares rule.

A document's token ids are cut into whole windows; what remains is placed online into the fill
level that keeps the sum of squared counts of partly filled windows smallest. The counts stand in an
array by level. Each partition packs its own documents in one pass, while the ids are at hand, so
no id is shuffled. At most ``max_open`` windows are open: beyond that, the next remainder
is cut to fill the fullest one. At a partition's end the open windows are strung together and cut
again into whole windows, and the last piece into windows whose lengths are powers of two, which
need no padding.

Recovery: a task depends on its input split alone. Sequence ids hold the partition's number, so a
task that runs again gives the same rows.

Defined results: null text counts as empty and gives the end id alone; null ids are kept; repeated
rows are packed each; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ship
from salesloom.llm.words import WordIds, blocks

#: Tokens per window, the id that ends a document, and the windows that may be open at once.
WINDOW = 4096
END_ID = 2
MAX_OPEN = 256
#: Bytes of text encoded at once.
BLOCK = 4 << 20
#: Sequence ids of a partition start at its number times this.
PER_PARTITION = 1 << 33

PIECES = "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long"
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


class Packer:
    """Online packing of one partition. An item is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN, first_sequence: int = 0):
        self.window, self.max_open = window, max_open
        self.sequence = first_sequence
        self.counts = np.zeros(window + 1, np.int64)  # open windows by fill level; both ends stay 0
        self.open: dict[int, list[list]] = {}
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes) -> None:
        total, at = len(ids) // 4, 0
        while total - at >= self.window:
            self._emit([self._item(doc_id, at, at + self.window, ids, total)])
            at += self.window
        if at < total and int(self.counts.sum()) >= self.max_open:
            fullest = int(np.flatnonzero(self.counts)[-1])
            cut = min(total, at + self.window - fullest)
            self._place(self._item(doc_id, at, cut, ids, total), fullest)
            at = cut
        if at < total:
            self._place(self._item(doc_id, at, total, ids, total), self.level(total - at))

    def level(self, size: int) -> int:
        """The fill level to put ``size`` tokens on; 0 opens a window."""
        counts, window = self.counts, self.window
        below = counts[: window - size + 1]
        change = 2 * (counts[size:] - below) + 2
        change[-1] -= 1  # a window that gets full is no longer counted
        change[below == 0] = np.iinfo(np.int64).max
        change[0] = 2 * counts[size] + 1
        return int(len(change) - 1 - np.argmin(change[::-1]))  # of equal ones the fullest

    def finish(self) -> None:
        """String the open windows together, fullest first, and cut them again."""
        rest = [item for fill in sorted(self.open, reverse=True) for items in self.open[fill] for item in items]
        left = sum(len(item[2]) // 4 for item in rest)
        self.open, self.counts[:] = {}, 0
        items = iter(rest)
        item = next(items, None)
        while left:
            room = min(self.window, 1 << (left.bit_length() - 1))
            left -= room
            sequence = []
            while room:
                doc_id, start, ids, total = item
                size = min(room, len(ids) // 4)
                sequence.append((doc_id, start, ids[: 4 * size], total))
                room -= size
                item = (doc_id, start + size, ids[4 * size :], total) if 4 * size < len(ids) else next(items, None)
            self._emit(sequence)

    @staticmethod
    def _item(doc_id, start: int, stop: int, ids: bytes, total: int) -> tuple:
        return doc_id, start, ids[4 * start : 4 * stop], total

    def _place(self, item: tuple, fill: int) -> None:
        items = []
        if fill:
            items = self.open[fill].pop()
            self.counts[fill] -= 1
        items.append(item)
        fill += len(item[2]) // 4
        if fill == self.window:
            self._emit(items)
        else:
            self.open.setdefault(fill, []).append(items)
            self.counts[fill] += 1

    def _emit(self, items: list) -> None:
        offset = 0
        for doc_id, start, ids, total in items:
            self.rows.append((doc_id, start, ids, total, self.sequence, offset))
            offset += len(ids) // 4
        self.sequence += 1

    def take(self) -> pa.RecordBatch:
        """The pieces placed so far, as a batch."""
        columns = zip(*self.rows) if self.rows else [[]] * len(_SCHEMA)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(c), f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA
        )
        self.rows = []
        return batch


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    max_open: int = MAX_OPEN,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, ids, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the path of a tokenizer file, the same on all executors. ``ids`` holds
    little-endian unsigned 32-bit integers.
    """
    ship(docs.sparkSession)
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer)
        packer = Packer(window, max_open, TaskContext.get().partitionId() * PER_PARTITION)
        for batch in batches:
            for at, stop in blocks(batch.column(1), BLOCK):
                part = batch.slice(at, stop - at)
                for doc_id, ids in zip(part.column(0).to_pylist(), words.encode(part.column(1))):
                    packer.add(doc_id, ids + end)
                yield packer.take()
        packer.finish()
        yield packer.take()

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, PIECES)
