"""The field against enumeration, held-out accuracy, spans and odd input."""

import itertools
import zlib

import numpy as np
import oracle
import pytest

from salesloom.llm import crf, toxicity

DOCS = "doc_id long, text string, score double, spans string"


@pytest.mark.parametrize("n", [1, 2, 5, 7])
def test_marginals_equal_enumeration(n):
    random = np.random.default_rng(n)
    field = crf.Crf(move=random.normal(size=(2, 2)))
    scores = random.normal(size=n)
    total, marginal, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=n):
        weight = np.exp(scores @ np.array(tags) + sum(field.move[a, b] for a, b in zip(tags, tags[1:])))
        total += weight
        marginal += weight * np.array(tags)
        for a, b in zip(tags, tags[1:]):
            pairs[a, b] += weight
    found, expected = field.marginals(scores, np.array([n]), expect=True)
    assert np.allclose(found, marginal / total) and np.allclose(expected, pairs / total)


def test_chains_of_different_lengths_do_not_mix():
    random = np.random.default_rng(2)
    field = crf.Crf(move=random.normal(size=(2, 2)))
    lengths = np.array([3, 1, 9, 4])
    scores = random.normal(size=lengths.sum())
    parts = np.split(scores, np.cumsum(lengths)[:-1])
    alone = np.concatenate([field.marginals(p, np.array([len(p)])) for p in parts])
    assert np.allclose(field.marginals(scores, lengths), alone)


def test_held_out_accuracy(spark):
    sf = f"{oracle.TESTDATA}/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.tag(docs, labels).where(toxicity.held_out()).join(labels, "doc_id").collect()
    toxic = np.array([r["toxic"] for r in scored]) == 1
    called = np.array([r["score"] for r in scored]) >= toxicity.TOXIC
    assert (toxic & called).sum() >= 0.85 * toxic.sum() and (~toxic & called).sum() <= 0.02 * (~toxic).sum()


@pytest.fixture(scope="module")
def model():
    random = np.random.default_rng(4)
    texts, labels = [], []
    for i in range(200):
        words = [f"word{random.integers(0, 300)}" for _ in range(40)]
        if i % 2:
            words[random.integers(0, 40)] = "Rotten!"
        texts.append(" ".join(words))
        labels.append(i % 2)
    return toxicity.fit(texts, labels)


def test_spans_are_code_points(model):
    text = "é 😀 word7\nword1 rotten, rotten word3\n  ROTTEN"
    (score, _, spans), (low, _, none) = model.score([text, "word1 word2"])
    assert [text[s["start"] : s["stop"]] for s in spans] == ["rotten, rotten", "ROTTEN"]
    assert score >= toxicity.TOXIC > low and none == []


def test_long_text_is_read_whole(model):
    text = " ".join(f"word{i % 300}" for i in range(60_000)) + " rotten"
    ((_, _, spans),) = model.score([text])
    assert [text[s["start"] : s["stop"]] for s in spans] == ["rotten"]


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (None, "rotten"), (3, " \n"), (3, " \n")]
    df = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], DOCS)
    got = toxicity.score(df, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] is not None}) == 1
    kept = toxicity.keep_clean(df, model)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 3]
    assert toxicity.score(df.where("false"), model).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1)], [(None, 1), (1, None)]])
def test_too_few_labels(spark, labels):
    df = spark.createDataFrame([(1, "some text", 0.1, "x")], DOCS)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    assert toxicity.tag(df, known).first()["score"] == 0.0


def test_held_out_fold(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
