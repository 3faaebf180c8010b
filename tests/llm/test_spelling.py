"""Words one edit apart against all pairs, and their forms and roots."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesloom.llm import queries
from salesloom.llm import spelling as s

WORDS = "word string, n long, form int, root string, key int"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts):
    out = {}
    for w, n in counts.items():
        near = sorted((-m, v) for v, m in counts.items() if one_edit(w, v) and min(len(w), len(v)) >= 4)
        form = near[0][1] if near and -near[0][0] >= 10 * n else None
        out[w] = (n, form, counts.get(form), len(near))
    for w in out:
        root = w
        while out[root][1]:
            root = out[root][1]
        out[w] = (*out[w], root)
    return out


def edited(rng, word, letters):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


def got(df):
    return {r["word"]: (r["n"], r["form"], r["form_n"], r["n_near"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzéß\U0001f600"])
def test_all_pairs(spark, letters):
    rng = random.Random(len(letters))
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(3, 12))) for _ in range(150)]
    words += ["a" * n for n in range(4, 12)] + ["ab" * 40, "ab" * 40 + "a", "abab"]
    while len(words) < 700:
        words.append(edited(rng, rng.choice(words), letters))
    counts = {w: rng.choice([2, 2, 3, 25, 30, 400, 5000]) for w in words if w}
    frame = spark.createDataFrame([(w, n, 0, "x", 1) for w, n in counts.items()], WORDS).repartition(5)
    assert got(s.variants(frame)) == expected(counts)


def test_repeated_null_and_no_words(spark):
    frame = spark.createDataFrame([("abcdefg", 1, 0, "", 0), ("abcdefg", 1, 0, "", 0), (None, 5, 0, "", 0), ("abcdef", 90, 0, "", 0)], WORDS)
    assert got(s.variants(frame)) == {"abcdefg": (2, "abcdef", 90, 1, "abcdef"), "abcdef": (90, None, None, 1, "abcdef")}
    assert s.variants(frame.where("false")).count() == 0


def test_roots_follow_all_forms(spark):
    counts = {"abcdefgh"[:k] + "x" * (12 - k): 10**k for k in range(1, 9)} | {"zzzzzzz": 3}
    frame = spark.createDataFrame([(w, n, 0, "x", 1) for w, n in counts.items()], WORDS)
    answer = got(s.variants(frame))
    assert answer == expected(counts) and answer["a" + "x" * 11][4] == "abcdefghxxxx"


@settings(deadline=None, max_examples=200)
@given(st.text("abc", min_size=4, max_size=12), st.text("abc", min_size=4, max_size=12))
def test_pivots_are_disjoint_and_cheapest(a, b):
    counts = np.arange(1 << s.GRAM_BITS)[::-1].copy()
    for word in (a, b):
        grams = s.grams_of(s.codes_of([word]))
        places, _ = s.prefixes(s.ranks_of(counts)[grams])
        costs = counts[np.take_along_axis(grams, places, 1)]
        picked = s.pick_pivots(places, costs)[0]
        price = dict(zip(places[0].tolist(), costs[0].tolist()))
        options = [price[x] + price[y] for x in price for y in price if y - x >= 2]
        assert picked[1] - picked[0] >= 2 and price[picked[0]] + price[picked[1]] == min(options)


def test_words_of_the_query(spark):
    docs = [(i if i % 7 else None, "Onerthly ONERTHLY a1onerthlyé, Édition-edition édition") for i in range(80)] + [(1, None), (2, "")]
    counts = {}
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] = counts.get(run, 0) + 1
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r["word"]: r["n"] for r in queries.misspelt_words(frame).collect()}
    assert found == {w: n for w, n in counts.items() if n >= 2}
