"""Ranked search against plain scores over all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np

from salesloom.llm import reversed_search as s

DOCS = "doc_id long, text string, item int, score string, terms int"
ITEMS = "item_id long, text string, place int, rank string"
_FOLD = {c: c + 32 for c in range(65, 91)}


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [t.translate(_FOLD) for t in found]


def expected(docs, items, top=20):
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in counts:
            m = 100 - 25 + (25 * c.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        for rank, (score, none, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, None if none else doc, -score))
    return sorted(out, key=str)


def made():
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(60)] + ["the"] * 20 + ["Été", "ÉTÉ", "x"]
    body = lambda n: rng.choice([" ", "_", ", "]).join(rng.choice(pool) for _ in range(n))
    docs = [(i // 2 if i % 5 else None, body(rng.choice([0, 1, 5, 40, 200]))) for i in range(300)]
    docs += [(999, "w1 " * 50_000), (998, None), (998, "?"), (7, "same words"), (7, "same words"), (8, "same words")]
    items = [(i % 9, body(rng.choice([0, 1, 4, 30]))) for i in range(30)] + [(None, "same words"), (5, None), (5, "unseen")]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 0, "x", 1) for i, t in docs], DOCS).repartition(7),
        spark.createDataFrame([(i, t, 0, "x") for i, t in items], ITEMS),
    )


def got(df):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in df.collect()), key=str)


def test_equals_plain_scores(spark):
    docs, items = made()
    assert got(s.search(*frames(spark, docs, items))) == expected(docs, items)


def test_blocks_of_items_give_the_same(spark):
    docs, items = made()
    assert got(s.search(*frames(spark, docs, items), top=3, block_terms=300)) == expected(docs, items, 3)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a")], [(1, "a b")])
    assert s.search(docs.where("false"), items).count() == 0
    assert s.search(docs, items.where("false")).count() == 0
    assert got(s.search(docs, items)) == expected([(1, "a")], [(1, "a b")])


def test_sums_of_large_numbers_are_exact():
    keys, values = np.array([0, 2, 2, 2]), np.array([5, 2**60 + 1, 2**60 + 1, 3])
    assert s.exact_sums(keys, values, 4).tolist() == [5, 0, 2**61 + 5, 0]


def test_heaps_keep_the_best_and_the_smallest_ids():
    heaps = s.Heaps(1, 2)
    heaps.offer([5, None, 9], np.array([[7], [7], [8]]))
    heaps.offer([4, 3], np.array([[7], [6]]))
    assert sorted(heaps.rows()) == [(0, 4, 7), (0, 9, 8)]
