"""Toxic spans by a linear-chain conditional random field; marginals add up to document scores.

Labels are per document, so tokens are labelled first: in toxic training documents, a token is
toxic if its word or its beginning stands in toxic documents far more often than chance allows
(a likelihood ratio over the sample). The field learns these tags from the word, its beginnings
and its end; forward-backward gives each token's probability, and a logistic curve over a
document's marginals, fitted on the document labels, gives the score.

Scale: the model is fitted on a bounded sample of labelled documents, ``SAMPLE`` of each label
(those with the smallest hash of their id), so its size is bounded and it is sent to all tasks.
Scoring is one pass without a shuffle; every document is read whole. A worker holds 256 documents
at a time and a bounded memory of word scores.

Recovery: a task depends on the model and its split alone.

Defined results: null and empty texts have no spans and the score of a text without toxic words.
Rows without a label, with a null id or of the held-out fold are not learnt from. Without any toxic
or any clean label all scores are 0. Repeated rows are scored each; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm import crf
from salesloom.llm.common import ship

#: Labelled documents of each label that are learnt from, at most.
SAMPLE = 1000
#: Marginal from which a token is part of an offending span.
SPAN = 0.5
#: From this score on a document counts as toxic.
TOXIC = 0.7
#: Chance that a harmless feature of the sample is taken for toxic, as a log-likelihood ratio.
EVIDENCE = 14.0

SCORED = "doc_id long, score double, n_toxic double, spans array<struct<start:int,stop:int>>"
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("score", pa.float64()),
        ("n_toxic", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ]
)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether an id belongs to the fold that is not learnt from; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    """The field, and the curve from a document's marginals to its score."""

    field: crf.Crf | None
    curve: np.ndarray

    def score(self, texts: list[str]) -> list[tuple[float, float, list[dict]]]:
        """(score, expected toxic words, spans as code point offsets) of each text."""
        if self.field is None:
            return [(0.0, 0.0, [])] * len(texts)
        docs = [crf.chains(t) for t in texts]
        words = [w for doc in docs for c in doc for w in c]
        lengths = np.array([len(c) for doc in docs for c in doc], np.int64)
        found = self.field.marginals(self.field.scores(words), lengths)
        ends = np.cumsum([sum(map(len, doc)) for doc in docs])
        parts = [found[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        scores = self._curve(np.array([_summary(p) for p in parts]).reshape(-1, 2))
        return [(float(s), float(p.sum()), _spans(t, p)) for s, p, t in zip(scores, parts, texts)]

    def _curve(self, summaries: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(summaries @ self.curve[:2] + self.curve[2])))


def _summary(marginals: np.ndarray) -> tuple[float, float]:
    """The largest marginal, and the expected number of toxic words on a log scale."""
    return (float(marginals.max()), float(np.log1p(marginals.sum()))) if len(marginals) else (0.0, 0.0)


def _spans(text: str, marginals: np.ndarray) -> list[dict]:
    """Offsets of the words above ``SPAN``; neighbours are one span."""
    if not (marginals > SPAN).any():
        return []
    spans, last = [], -2
    for i, (match, p) in enumerate(zip(re.finditer(r"\S+", text), marginals)):
        if p > SPAN:
            if i == last + 1:
                spans[-1]["stop"] = match.end()
            else:
                spans.append({"start": match.start(), "stop": match.end()})
            last = i
    return spans


def _tag(docs: list[list[list[str]]], toxic: np.ndarray) -> list[np.ndarray]:
    """0/1 per word: whether it makes its toxic document toxic."""

    def cues(word: str) -> list[str]:
        return [f for f in crf.features(word) if f[0] == "w" or (f[0] == "p" and len(f) >= 6)]

    counts = [Counter(), Counter()]
    for doc, label in zip(docs, toxic):
        counts[label].update({f for w in {w for c in doc for w in c} for f in cues(w)})
    n, t = (toxic == 0).sum(), (toxic == 1).sum()
    rate = t / (n + t)
    telling = set()
    for cue, a in counts[1].items():
        b = counts[0][cue]
        share = a / (a + b)
        evidence = a * np.log(share / rate) + (b * np.log((1 - share) / (1 - rate)) if b else 0)
        if evidence >= EVIDENCE and a / t >= 5 * b / n:
            telling.add(cue)
    known: dict[str, bool] = {}
    tags = []
    for doc, label in zip(docs, toxic):
        row = [0] * sum(map(len, doc))
        if label:
            for i, word in enumerate(w for c in doc for w in c):
                if word not in known:
                    known[word] = any(f in telling for f in cues(word))
                row[i] = int(known[word])
        tags.append(np.array(row))
    return tags


def _fit_curve(summaries: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, lightly held."""
    x = np.column_stack([summaries, np.ones(len(summaries))])
    w = np.zeros(3)
    hold = np.diag([0.1, 0.1, 0.01])
    for _ in range(25):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + hold, x.T @ (toxic - p) - hold @ w)
    return w


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Fit field and curve on labelled texts."""
    labels = np.array(toxic, np.int64)
    if not len(labels) or labels.min() == labels.max():
        return Model(None, np.zeros(3))
    docs = [crf.chains(t) for t in texts]
    tags = _tag(docs, labels)
    model = Model(crf.fit(docs, tags), np.zeros(3))
    lengths = np.array([len(c) for doc in docs for c in doc], np.int64)
    found = model.field.marginals(model.field.scores([w for doc in docs for c in doc for w in c]), lengths)
    ends = np.cumsum([sum(map(len, doc)) for doc in docs])
    parts = [found[a:b] for a, b in zip([0, *ends[:-1]], ends)]
    model.curve = _fit_curve(np.array([_summary(p) for p in parts]), labels)
    return model


def training_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> tuple[list[str], list[int]]:
    """Texts and labels of at most ``sample`` ids of either label, out of the training folds."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    draw = F.xxhash64(F.lit("sample"), "doc_id")
    picked = [known.where(F.col("toxic") == t).orderBy(draw).limit(sample) for t in (0, 1)]
    # at most 2 * sample ids, so the hint is safe and the texts stay where they are
    ids = F.broadcast(picked[0].unionAll(picked[1]))
    rows = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .join(ids, "doc_id")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))
        .orderBy("doc_id")
        .collect()
    )
    return [r["text"] or "" for r in rows], [r["toxic"] for r in rows]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_toxic (expected toxic words) and spans of each document."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = model.score([t or "" for t in part.column(1).to_pylist()])
                columns = [part.column(0).to_pylist(), *map(list, zip(*rows))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA
                )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, SCORED)


def tag(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on the labelled training documents and score all."""
    return score(docs, fit(*training_sample(docs, labels)))


def keep_clean(
    docs: DataFrame, model: Model, text_col: str = "text", threshold: float = TOXIC
) -> DataFrame:
    """Rows of ``docs`` whose score is below ``threshold``, with all their columns; nothing is shuffled."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at_text = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                scores = model.score([t or "" for t in part.column(at_text).to_pylist()])
                yield part.filter(pa.array([s < threshold for s, _, _ in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
