"""Spelling variants: words one edit apart, found by pivotal bigrams.

1. Bigrams are ordered by the number of words that have them, the rarest first. A word's prefix are its three
   rarest bigrams, with every other place of the third one. Of the three, dynamic programming picks the
   two disjoint ones of the least sum of frequencies: its pivots. One edit harms one pivot at most. So
   of two words one edit apart, the one whose prefix ends earlier in the order has a pivot that stands
   unharmed in the other's prefix.
2. Position limits: an unharmed bigram has the edit on its right or on its left. On the other side both
   words agree; on the edit's side the one half or the other agrees as well, halves being counted in the
   word with the prefix. So a place of a bigram is indexed by four keys: its side, its position, the
   length, and a hash of the bigram with the parts that must agree. Pivots are looked up under the same
   keys, for lengths of one less, the same and one more.
3. Words that meet under a key are verified by their edit distance.

Scale: a word gives some 12 keys to the index and 24 to the look-up, whatever the corpus. They meet by a
sort-merge join whose hot keys adaptive execution splits; its condition is the verification, so no
unverified pair leaves the join. A key fixes more than half of a word, hence few words share one. Rows of
documents are never shuffled, only words with their counts, combined before the shuffle. Sent to
executors: 65,536 counts (bigrams are ordered by a hash of 16 bits, ties are one bigram).

Recovery: words, pairs and the answer are stored in the shared folder.

Defined results: words are compared by code points. Words of fewer than four code points have too few bigrams
and are near to nothing. Null words are dropped, repeated ones are one word with the sum of their counts. An empty table
gives none, and other columns are ignored. Roots follow forms, whose counts grow tenfold each step, so no path is longer than 18 steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ship
from salesloom.operators.staging import stage

#: Bigrams of the prefix (q * edits + 1), pivots (edits + 1), and the least length with so many bigrams.
PREFIX, PIVOTS, LEAST = 3, 2, 4
#: A form has at least so many times the word's occurrences.
FORM_TIMES = 10
#: Bits of a bigram's hash; words worked on at once.
GRAM_BITS, SLICE = 16, 4096

_M = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_KEYS = pa.schema([("key", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int32())])


def codes_of(words: list[str]) -> np.ndarray:
    """Code points of words of one length, one word a row."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def grams_of(codes: np.ndarray) -> np.ndarray:
    """The bigrams of each word, as hashes."""
    mixed = (codes[:, :-1] * _M[0] ^ codes[:, 1:] * _M[1]) * _M[2]
    return (mixed >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def by_length(words: list[str]) -> dict[int, np.ndarray]:
    """Places of the words of each length that has bigrams enough."""
    lengths = np.array([len(w) for w in words], np.int64)
    return {n: np.flatnonzero(lengths == n) for n in np.unique(lengths[lengths >= LEAST]).tolist()}


def gram_counts(words: DataFrame) -> np.ndarray:
    """Words that have each bigram. Every task sends its counts, at most one row a bigram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << GRAM_BITS, np.int64)
        for batch in batches:
            found = batch.column(0).to_pylist()
            for length, places in by_length(found).items():
                grams = np.sort(grams_of(codes_of([found[i] for i in places])), axis=1)
                first = np.ones(grams.shape, bool)
                first[:, 1:] = grams[:, 1:] != grams[:, :-1]
                counts += np.bincount(grams[first], minlength=len(counts))
        known = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(known, pa.int32()), pa.array(counts[known])], ["gram", "n"])

    counts = np.zeros(1 << GRAM_BITS, np.int64)
    for row in words.select("word").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]
    return counts


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Place of each bigram in the order, the rarest first."""
    ranks = np.empty(len(counts), np.int64)
    ranks[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
    return ranks


def prefixes(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the rarest bigrams, in the order of the word, and the rank of the last of them."""
    order = np.argsort(ranks * ranks.shape[1] + np.arange(ranks.shape[1]), axis=1)[:, :PREFIX]
    return np.sort(order, axis=1), np.take_along_axis(ranks, order[:, -1:], 1)[:, 0]


def pick_pivots(places: np.ndarray, costs: np.ndarray) -> np.ndarray:
    """Per word the positions of disjoint bigrams with the least sum of costs, by dynamic programming.

    ``best[i]`` is the least sum of so many disjoint bigrams of which the last is the i-th of the prefix.
    """
    n, width = places.shape
    best, chosen = costs.astype(np.float64), places[:, :, None]
    for taken in range(1, PIVOTS):
        more = np.full((n, width), np.inf)
        paths = np.zeros((n, width, taken + 1), np.int64)
        for i in range(width):
            for j in range(i):
                total = np.where(places[:, i] - places[:, j] >= 2, best[:, j] + costs[:, i], np.inf)
                better = total < more[:, i]
                more[better, i] = total[better]
                paths[better, i, :taken] = chosen[better, j]
                paths[better, i, taken] = places[better, i]
        best, chosen = more, paths
    return np.take_along_axis(chosen, best.argmin(1)[:, None, None], 1)[:, 0]


class Hashes:
    """Hashes of all parts of words of one length."""

    def __init__(self, codes: np.ndarray):
        n, self.length = codes.shape
        self.powers = np.cumprod(np.array([1, *[_M[0]] * self.length], np.uint64))
        self.sums = np.zeros((n, self.length + 1), np.uint64)
        for i in range(self.length):
            self.sums[:, i + 1] = self.sums[:, i] * _M[0] + codes[:, i] + np.uint64(1)

    def part(self, rows: np.ndarray, start, stop) -> np.ndarray:
        stop = np.broadcast_to(stop, rows.shape)
        start = np.minimum(start, stop)  # a part that is not there is masked by the caller
        return self.sums[rows, stop] - self.sums[rows, start] * self.powers[stop - start]

    def key(self, kind: int, length: int, place: np.ndarray, first: np.ndarray, second) -> np.ndarray:
        """One number for the kind of key, the other word's length, the bigram's position and two parts."""
        label = (np.uint64(kind * 65536 + length) << np.uint64(32)) + place.astype(np.uint64)
        mixed = (first * _M[1] ^ second * _M[2]) + label * _M[3]
        mixed ^= mixed >> np.uint64(29)
        return (mixed * _M[0]).view(np.int64)


def keys_of(hashes: Hashes, rows: np.ndarray, places: np.ndarray, indexed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words' rows, keys) of bigrams at ``places``, to meet an indexed word of length ``indexed``.

    The indexed word itself has that length; a word that is looked up is up to one longer or shorter.
    """
    none, own = np.uint64(0), hashes.length
    longer = own - indexed

    def some(mask, kind, place, first, second):
        return rows[mask], hashes.key(kind, indexed, place[mask], first[mask], second if second is none else second[mask])

    # the edit is right of the bigram; ``near`` of the indexed word's rest is its first half
    rest = indexed - places - 2
    near = (rest + 1) // 2
    left, cut = hashes.part(rows, 0, places + 2), places + 2 + near
    can = (rest >= 0) & (rest + longer >= 0) & ((rest > 0) | (longer != 0))
    yield some(can & (cut <= own), 0, places, hashes.part(rows, 0, np.minimum(cut, own)), none)
    yield some(can & (near > 0), 1, places, left, hashes.part(rows, np.clip(cut + longer, 0, own), own))

    # the edit is left of it; ``far`` of what stands there in the indexed word is its first half
    before = places - longer
    far = (before + 1) // 2
    can = (before >= 0) & ((before > 0) | (places > 0))
    right = hashes.part(rows, places, own)
    yield some(can & (far <= places), 2, before, hashes.part(rows, 0, np.clip(far, 0, own)), right)
    yield some(can & (far > 0), 3, before, hashes.part(rows, np.clip(far + longer, 0, own), own), none)


def word_keys(words: DataFrame, counts: np.ndarray, look_up: bool) -> DataFrame:
    """(key, word, n, last) of the words' prefixes, or of their pivots for a look-up."""
    sent = words.sparkSession.sparkContext.broadcast((counts, ranks_of(counts)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, ranks = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                words = part.column(0).to_pylist()
                found_places, found_keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                lasts = np.zeros(len(words), np.int32)
                for length, members in by_length(words).items():
                    codes = codes_of([words[i] for i in members])
                    grams = grams_of(codes)
                    placed, last = prefixes(ranks[grams])
                    lasts[members] = last
                    hashes = Hashes(codes)
                    if look_up:
                        pivots = pick_pivots(placed, counts[np.take_along_axis(grams, placed, 1)])
                        rows, places = np.repeat(np.arange(len(members)), PIVOTS), pivots.ravel()
                        lengths = (length - 1, length, length + 1)
                    else:
                        rows, places = np.nonzero(ranks[grams] <= last[:, None])
                        lengths = (length,)
                    for indexed in lengths:
                        for chosen, keys in keys_of(hashes, rows, places, indexed):
                            found_places.append(members[chosen])
                            found_keys.append(keys)
                take = pa.array(np.concatenate(found_places))
                arrays = [pa.array(np.concatenate(found_keys)), part.column(0).take(take), part.column(1).take(take)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(lasts).take(take)], schema=_KEYS)

    return words.select("word", F.col("n").cast("long")).mapInArrow(run, "key long, word string, n long, last int")


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of all words one edit apart, each pair once, a before b."""
    counts = gram_counts(words)
    indexed = word_keys(words, counts, False).alias("i")
    looked_up = word_keys(words, counts, True).alias("l").hint("merge")
    # the word whose prefix ends earlier brings the pivots
    meets = (F.col("i.key") == F.col("l.key")) & (F.col("l.last") <= F.col("i.last"))
    apart = F.levenshtein(F.col("i.word"), F.col("l.word"), 1) == 1
    met = indexed.join(looked_up, meets & apart)
    ahead = F.col("i.word") < F.col("l.word")
    return met.select(
        F.when(ahead, F.col("i.word")).otherwise(F.col("l.word")).alias("a"),
        F.when(ahead, F.col("i.n")).otherwise(F.col("l.n")).alias("a_n"),
        F.when(ahead, F.col("l.word")).otherwise(F.col("i.word")).alias("b"),
        F.when(ahead, F.col("l.n")).otherwise(F.col("i.n")).alias("b_n"),
    ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form; paths halve in each round, so five rounds are enough."""
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        met = now.join(step, "root", "left")
        now = stage(met.select("word", F.coalesce("further", "root").alias("root"), "further"), "spelling_roots")
        if now.where("further IS NOT NULL").isEmpty():
            return now.drop("further")
        now = now.drop("further")


def variants(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """word, n, form, form_n, n_near and root of each row of ``words`` (word, n)."""
    ship(words.sparkSession)
    words = words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").cast("long").alias("n"))
    words = stage(words, "spelling_words")
    pairs = stage(near_pairs(words), "spelling_pairs")
    both = pairs.unionAll(pairs.select("b", "b_n", "a", "a_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("minus"), F.col("b").alias("form")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    judged = words.join(near, "word", "left")
    has = -F.col("best.minus") >= F.col("n") * times
    judged = stage(
        judged.select(
            "word",
            "n",
            F.when(has, F.col("best.form")).alias("form"),
            F.when(has, -F.col("best.minus")).alias("form_n"),
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        ),
        "spelling_judged",
    )
    rooted = judged.join(_roots(judged.where("form IS NOT NULL")), "word", "left")
    return rooted.withColumn("root", F.coalesce("root", "word"))
