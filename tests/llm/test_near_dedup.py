"""Near duplicates against a comparison of all pairs; sketches and components on their own."""

import brute
import numpy as np
import oracle
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesloom.llm import components, near_dedup, shingles

SF = f"{oracle.TESTDATA}/sf0.001"
DOCS = "doc_id long, text string"


def verdicts(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = near_dedup.dedup(docs, percent=85)
    assert verdicts(got) == brute.near_components(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got.collect())


def test_edges(spark):
    words = [f"w{i}" for i in range(60)]
    base = " ".join(words)
    near = " ".join(words[:-1] + ["other"])
    far = " ".join(words[:30] + [f"x{i}" for i in range(30)])
    long = " ".join(f"z{i}" for i in range(200_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "Two words"), (5, "two\nWORDS"), (6, "two word"),
        (10, base), (11, base.upper().replace(" ", "\t")), (12, near), (13, far), (14, long), (15, long + " end"),
        (None, base), (7, "É é"), (8, "é é"),
    ]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS + ", class string, Registers string")
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.dedup(df, percent=85).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True),
            (10, 10, True), (11, 10, False), (12, 10, False), (13, 13, True), (14, 14, True), (15, 14, False),
            (None, 10, False), (7, 7, True), (8, 8, True),
        ],
        key=str,
    )


def test_empty_table(spark):
    assert near_dedup.dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    random = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(70):
        words = list(base)
        for k in random.integers(0, 120, random.integers(0, 4)):
            words[k] = f"v{random.integers(0, 50)}"
        rows.append((i, " ".join(words)))
    got = verdicts(near_dedup.dedup(spark.createDataFrame(rows, DOCS), percent=85))
    assert got == brute.near_components(rows)


def test_short_texts_share_no_band(spark):
    rows = [(i, f"left{i} right{i * 7}") for i in range(3000)]
    sketched = near_dedup.sketches(spark.createDataFrame(rows, DOCS))
    for percent in (80, 85):
        assert near_dedup.candidate_groups(sketched.select("class", "registers"), percent).count() == 0
    kept = [shingles.registers(np.array([i], np.uint64)) for i in range(2000)]
    assert min(r.min() for r in kept) > 0 and max(r.max() for r in kept) < shingles.LARGEST


def test_rows_without_an_id_or_with_one_id_meet_their_own_class_only(spark):
    """Pairs of near copies, a third of the rows without an id and a third with the same one."""
    rows = []
    for i in range(120):
        words = [f"w{i}x{k}" for k in range(60)]
        for text in (" ".join(words), " ".join([*words[:-1], "other"]), " ".join(words)):
            rows.append(((None, 5, 1000 + i)[i % 3], text))
    docs = spark.createDataFrame(rows, DOCS)
    sketched = near_dedup.sketches(docs)
    row = "min(struct(doc_id is null, doc_id, text_hash)) AS row"
    classes = sketched.groupBy("class").agg(F.expr(row)).select("class", "row.doc_id", "row.text_hash")
    wanted = classes.select("*", *[F.lit(b"r").alias("root"), F.lit(1).alias("blocks"), F.lit(0).alias("own")])
    assert near_dedup._sets_of(docs, wanted, "doc_id", "text").count() == 240
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in near_dedup.dedup(docs).collect())
    assert got == sorted((d or 0, 56, d or 0) for d, _ in rows)


def test_registers_merge():
    sets = [np.arange(a, b, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for a, b in ((0, 500), (300, 900), (0, 900))]
    one, two, union = map(shingles.registers, sets)
    assert (np.maximum(one, two) == union).all()


def test_joint_estimate_is_near_the_similarity():
    random = np.random.default_rng(5)
    errors = []
    for _ in range(60):
        x = random.integers(0, 1 << 63, 1000, np.uint64)
        a, b = np.unique(x[:900]), np.unique(x[100:])
        ra, rb = shingles.registers(a), shingles.registers(b)
        found = shingles.joint_estimate(
            np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([900.0]), np.array([900.0])
        )
        errors.append(found[0] - 0.8)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_word_hashes_do_not_depend_on_the_block():
    texts = ["One two three four five six".encode(), "é ü".encode(), b"", b"one TWO three\nfour\x0bfive  six"]
    together = list(shingles.shingle_sets(texts))
    alone = [next(shingles.shingle_sets([t])) for t in texts]
    for (a, d), (b, e) in zip(together, alone):
        assert (a == b).all() and d == e
    assert together[0][1] == together[3][1] and together[2][1] is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    if not edges:
        return
    parent = list(range(31))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    touched = {x for a, b in edges if a != b for x in (a, b)}
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["root"] for r in got.collect()} == {x: find(x) for x in touched}


def test_long_path_settles(spark):
    got = components.components(spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long"))
    assert {r["root"] for r in got.collect()} == {0}


@pytest.mark.parametrize("n", [2, 5])
def test_links_within_and_between_blocks(n):
    sets = [np.arange(100 + i % 2, dtype=np.uint64) for i in range(n)]
    sketch = np.array([shingles.registers(s) for s in sets])
    names = [bytes([i]) for i in range(n)]
    assert len(near_dedup.verified_links(names, sets, sketch, np.zeros(n, int), 85)) == n - 1
    sides = np.array([i % 2 for i in range(n)])
    assert near_dedup.verified_links(names, sets, sketch, sides, 85)
