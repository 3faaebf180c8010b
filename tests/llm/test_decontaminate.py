"""Phrases of the tests in the documents: exact and near matches against plain loops."""

import random
import re

from pyspark.sql import functions as F

from salesloom.llm import decontaminate as d
from salesloom.operators.staging import staged_path

DOCS = "doc_id long, text string, row int, term string, phrase string, items int"
ITEMS = "item_id long, text string, phrase int, terms string"
_FOLD = {c: c + 32 for c in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_FOLD))


def phrases(text, window=10):
    w = words(text)
    return [w[i : i + window] for i in range(max(1, len(w) - window + 1))] if w else []


def expected(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            for p in phrases(body, window):
                for i in range(len(w) - len(p) + 1):
                    if w[i : i + len(p)] == p:
                        hit.update(range(i, i + len(p)))
                        found.add("null" if item is None else str(item))
        out.append((doc_id, len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit)))
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 0, "x", "y", 1) for i, t in docs], DOCS),
        spark.createDataFrame([(i, t, 0, "x") for i, t in items], ITEMS),
    )


def got(df):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items", "contaminated"]
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def made(seed):
    """Texts of few words, so that terms repeat within a phrase and phrases overlap."""
    rng = random.Random(seed)
    body = lambda n: " ".join(rng.choice(["a", "B", "é", "c1", "dd", "Ää"]) for _ in range(n))
    items = [(i % 7 if i % 5 else None, body(rng.choice([0, 1, 3, 6, 9, 14]))) for i in range(20)] + [(9, None), (8, "?!")]
    docs = [(i // 2 if i % 3 else None, body(rng.choice([0, 2, 12, 60]))) for i in range(60)] + [(7, None), (7, ""), (7, "")]
    docs += [(200 + i, body(3) + ". " + (items[i][1] or "").upper() + " x " + (items[i][1] or "")) for i in range(20)]
    docs += [(300, " ".join(["zz"] * 50) + " " + body(30_000))]
    return docs, items


def test_equals_plain_search(spark):
    for window in (10, 4):
        docs, items = made(window)
        assert got(d.decontaminate(*frames(spark, docs, items), window=window)) == expected(docs, items, window)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b c"), (None, None)], [(1, "a b c")])
    assert d.decontaminate(docs.where("false"), items).count() == 0
    none = got(d.decontaminate(docs, items.where("false")))
    assert none == [(1, 3, 0, 0, "", False), (None, 0, 0, 0, "", False)]


def plain_spans(text, phrase, width):
    w, due = words(text), set(phrase)
    return {i for i in range(len(w)) if w[i] in due and due <= set(w[i : i + width])}


def test_near_matches_equal_plain_spans(spark):
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(9)] + ["the"] * 6
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([0, 5, 40, 120])))) for i in range(60)]
    items = [(i, " ".join(rng.choice(pool) for _ in range(rng.choice([1, 2, 4])))) for i in range(25)]
    frame, tests = frames(spark, docs, items)
    path = staged_path(spark, "test_postings")
    index = d.build_index(frame, path)
    postings = spark.table(index)
    found, members = d.phrases_of(tests)
    near = d.near_matches(postings, found, 7).join(members, "phrase")
    ids = postings.where("term IS NULL").select("row", "doc_id")
    spans = {(r["doc_id"], r["item"], r["start"]) for r in near.join(ids, "row").collect()}
    assert spans == {(i, str(j), s) for i, t in docs for j, b in items for s in plain_spans(t, words(b), 7)}
    d.drop_index(spark, index, path)


def test_the_index_is_searched_in_its_buckets(spark):
    frame, tests = frames(spark, [(i, f"one two three w{i}") for i in range(50)], [(1, "two three w7")])
    path = staged_path(spark, "test_postings")
    index = d.build_index(frame, path)
    postings = spark.table(index)
    assert postings.where("term IS NOT NULL").count() == 200
    rows = postings.select("row").where("pos = 3").distinct()
    due = postings.where("term IS NOT NULL").groupBy("row", "pos").agg(F.count(F.lit(1)))
    assert "Exchange" not in due._jdf.queryExecution().executedPlan().toString()
    terms = spark.createDataFrame([(1,)], "term long")
    plan = d._of_rows(postings, terms, rows)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "hashpartitioning(row" not in plan
    d.drop_index(spark, index, path)
    assert not spark.catalog.tableExists(index)
