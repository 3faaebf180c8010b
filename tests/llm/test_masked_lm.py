"""The window network: proper distributions, better than shares alone, odd input."""

import zlib

import numpy as np
import oracle
import pyarrow as pa
import pytest

from salesloom.llm import masked_lm

DOCS = "doc_id long, text string, n int, log_prob string"


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{oracle.TESTDATA}/sf0.01/documents.parquet")
    return docs, masked_lm.train(docs)


def test_probabilities_add_up(trained):
    _, model = trained
    padded = np.full(7, masked_lm.BLANK)
    padded[[1, 2, 4]] = [5, 700, 8300]
    every = np.arange(masked_lm.SYMBOLS)
    found = model.token_log_probs(every, padded, np.full(len(every), 3))
    assert abs(np.exp(found).sum() - 1) < 1e-4


def test_both_sides_help(trained):
    docs, model = trained
    texts = [r["text"].encode() for r in docs.limit(300).collect()]
    tokens, padded, places, _ = masked_lm.lay_out([model.encode(t) for t in texts])
    found = model.token_log_probs(tokens, padded, places).mean()
    blank = model.token_log_probs(tokens, np.full_like(padded, masked_lm.BLANK), places).mean()
    shares = np.log(np.bincount(model.cluster[tokens], minlength=masked_lm.CLUSTERS)[model.cluster[tokens]] / len(tokens))
    assert found > blank and found > (shares + model.share[tokens]).mean()


def test_shuffled_words_score_lower_across_languages(trained):
    docs, model = trained
    texts = {lang: [r["text"].split() for r in docs.where(f"lang = '{lang}'").limit(40).collect()] for lang in ("en", "fr")}
    a, b = (sum(texts[lang], [])[:4000] for lang in ("en", "fr"))
    mixed = [w for pair in zip(a, b) for w in pair]
    straight = model.score([" ".join(a).encode()])[0][1] + model.score([" ".join(b).encode()])[0][1]
    assert straight > model.score([" ".join(mixed).encode()])[0][1]


def test_odd_rows(spark, trained):
    _, model = trained
    rows = [(1, None), (2, ""), (None, "the the"), (3, "The  THE\n"), (4, "word " * 100_000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)
    got = {r["doc_id"]: r for r in masked_lm.score(df, model).collect()}
    assert got[1]["n_tokens"] == 0 and got[1]["log_prob"] == 0 and got[2]["mean_log_prob"] is None
    assert got[None]["log_prob"] == pytest.approx(got[3]["log_prob"]) and got[4]["n_tokens"] == 100_000
    assert masked_lm.score(df.where("false"), model).count() == 0
    assert masked_lm.train(df.where("false")).score([b"a b"])[0][0] == 2


def test_counts_cover_all_texts(spark):
    df = spark.createDataFrame([(1, "A b\ta", 1, "x"), (2, None, 1, "x"), (3, "b c", 1, "x")], DOCS)
    assert dict(masked_lm.word_counts(df).collect()) == {"a": 2, "b": 2, "c": 1}


def test_every_document_is_learnt_from(spark, monkeypatch):
    """400,000 tokens of one text's words, and 40 of others that only one document has."""
    monkeypatch.setattr(masked_lm, "PASSES", 1)
    rows = [(i, "one two three four five " * 400, 1, "x") for i in range(200)]
    rows.append((200, "alpha beta gamma delta " * 10, 1, "x"))
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    sent = []
    monkeypatch.setattr(masked_lm, "_averaged", lambda model, squares, sums: sent.append(sums))
    model = masked_lm.train(df)
    seen = sent[0][1 : masked_lm.SYMBOLS + 2]
    assert sent[0][0] == 400_040
    for word, n in (("one", 80_000), ("alpha", 10)):
        assert seen[model.encode(word.encode())[0]] >= n


def test_vocabulary_is_the_most_frequent_words(spark):
    words = [(f"w{i:05d}", 1 + i // 3) for i in range(2000)]
    counts = spark.createDataFrame(words, "word string, n long").repartition(5)
    found = [(r["word"], r["n"]) for r in masked_lm.most_frequent(counts, 100)]
    assert found == sorted(words, key=lambda r: (-r[1], r[0]))[:100]


def test_rare_words_have_their_own_share(spark, monkeypatch):
    """A word that is counted twice as often, or never, in one bucket differs by that alone."""
    monkeypatch.setattr(masked_lm, "most_frequent", lambda counts, most: counts.orderBy("word").limit(0).collect())
    bucket = {}
    for i in range(5000):
        bucket.setdefault(masked_lm.zlib.crc32(b"q%d" % i) % masked_lm.BUCKETS, []).append(f"q{i}")
    often, once, never = next(b for b in bucket.values() if len(b) >= 3)[:3]
    docs = spark.createDataFrame([(1, f"{often} {often} {often} {once}", 1, "x")], DOCS)
    model = masked_lm.train(docs)
    asked = spark.createDataFrame([(1, often, 1, "x"), (2, once, 1, "x"), (2, once, 1, "x"), (3, never, 1, "x")], DOCS)
    got = sorted((r["doc_id"], r["mean_log_prob"]) for r in masked_lm.score(asked, model).collect())
    symbol = model.score([often.encode()])[0][1]
    for (_, found), n in zip(got, (3, 1, 1, 0.5)):
        assert found == pytest.approx(symbol + np.log(n / 4.5), abs=1e-5)
    assert len(got) == 4


def test_words_are_runs_of_bytes_other_than_ascii_space():
    every = "".join(f"{chr(i)}aB{chr(i)}{chr(i)}" for i in range(0x3100))
    texts = [every, "", None, " ", "\x0b\x0cA b\x1c c\n", *(f"{chr(i)}x{chr(i)}Y" for i in range(300))]
    words, n = masked_lm.words_of(pa.array(texts))
    plain = [(t or "").encode().lower().split() for t in texts]
    assert words.to_pylist() == sum(plain, []) and n.tolist() == [len(p) for p in plain]


def test_checksums_of_words_of_any_length():
    words = pa.array([bytes(range(i % 40)) for i in range(200)] + [b"x" * 100_000, b"", b"a"], pa.binary())
    for some in (words, words.slice(7, 100), words.slice(39, 2), words.slice(3, 0), pa.array([b""], pa.binary())):
        assert masked_lm.checksums(some).tolist() == [zlib.crc32(w) for w in some.to_pylist()]


def _plain_step(weights, squares, cluster, runs):
    """The step by loops over places, in doubles."""
    side, slopes = masked_lm.SIDE, [np.zeros_like(w) for w in weights]
    embed, hidden, hidden_bias, out, out_bias = weights
    places = [(run, i) for run in runs for i in range(side, len(run) - side) if run[i] != masked_lm.BLANK]
    for run, i in places:
        left, right = run[i - side : i], run[i + 1 : i + 1 + side]
        x = np.concatenate([embed[left].sum(0), embed[right].sum(0)])
        h = np.tanh(x @ hidden + hidden_bias)
        p = np.exp(h @ out + out_bias)
        p /= p.sum()
        p[cluster[run[i]]] -= 1
        p /= len(places)
        back = (out @ p) * (1 - h**2)
        for k, g in enumerate((np.outer(x, back), back, np.outer(h, p), p), 1):
            slopes[k] += g
        wide = hidden @ back
        for symbols, g in ((left, wide[: masked_lm.WIDTH]), (right, wide[masked_lm.WIDTH :])):
            for s in symbols:
                slopes[0][s] += g
    for w, s, g in zip(weights, squares, slopes):
        s += g**2
        w -= 0.1 * g / np.sqrt(s)


def _texts(n):
    random = np.random.default_rng(5)
    return [(random.zipf(1.3, size) % masked_lm.SYMBOLS).astype(np.int16) for size in random.integers(1, 400, n)]


def _small_model():
    texts = _texts(20)
    near = masked_lm.neighbours(iter(texts)).reshape(masked_lm.SYMBOLS, masked_lm.SIGNS + 1)
    return masked_lm.untrained([], np.bincount(np.concatenate(texts), minlength=masked_lm.SYMBOLS).astype(float), near)


def test_learning_is_that_of_plain_loops():
    """Three whole steps and a part of one."""
    model, texts = _small_model(), _texts(10)
    squares = [np.full_like(w, 1e-3) for w in model.weights()]
    sums = masked_lm.learn(model, squares, iter(texts), (1, 2))
    padded = masked_lm.lay_out([t.astype(np.int64) for t in texts])[1]
    side, run, runs = masked_lm.SIDE, masked_lm.RUN, -(-(len(padded) - 2 * masked_lm.SIDE) // masked_lm.RUN)
    laid = np.full(runs * run + 2 * side, masked_lm.BLANK)
    laid[: len(padded)] = padded
    rows = [laid[k * run : (k + 1) * run + 2 * side] for k in np.random.default_rng((1, 2)).permutation(runs)]
    assert runs > masked_lm.RUNS and runs % masked_lm.RUNS
    weights, plain = [w.astype(float) for w in model.weights()], [s.astype(float) for s in squares]
    for at in range(0, runs, masked_lm.RUNS):
        _plain_step(weights, plain, model.cluster, rows[at : at + masked_lm.RUNS])
    masked_lm._averaged(model, squares, sums)
    for found, asked in zip(model.weights() + squares, weights + plain):
        assert np.allclose(found, asked, rtol=1e-3, atol=1e-5)


def test_places_are_sorted_once_for_many_steps(monkeypatch):
    model, texts = _small_model(), _texts(200)
    sorts, plain = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda *a, **b: sorts.append(1) or plain(*a, **b))
    masked_lm.learn(model, [np.full_like(w, 1e-3) for w in model.weights()], iter(texts), (1, 2))
    assert sum(map(len, texts)) > 30 * masked_lm.RUNS * masked_lm.RUN and len(sorts) <= 2


def test_large_logits_stay_in_range():
    model = _small_model()
    model.out_bias = model.out_bias + np.linspace(0, 300, masked_lm.CLUSTERS, dtype=np.float32)
    tokens, padded, places, _ = masked_lm.lay_out([t.astype(np.int64) for t in _texts(5)])
    assert np.isfinite(model.token_log_probs(tokens, padded, places)).all()
    sums = masked_lm.learn(model, [np.full_like(w, 1e-3) for w in model.weights()], iter(_texts(5)), (1, 2))
    assert np.isfinite(sums).all()
