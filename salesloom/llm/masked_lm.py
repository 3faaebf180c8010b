"""Masked pseudo-likelihood: a bidirectional window network scores documents.

Each token is predicted from the tokens on both sides of it, as if it were masked; the sum of the
log-probabilities is the document's score. The network (in numpy) sums the embeddings of the three
tokens to the left and of the three to the right, has one hidden layer, and gives the token's cluster;
the token's share of its cluster is its share of the corpus. Both steps are proper
distributions, so their product is.

The vocabulary is the ``VOCABULARY`` most frequent words, equal counts in the order of their spelling.
To the network, words outside are one of ``BUCKETS`` symbols by the checksum of their spelling; a score
takes each such word's own share of its bucket, n / (bucket + 0.5) for a word counted n times.
Words that the corpus did not have share the remaining 0.5.

What is counted covers all documents: every word's count is aggregated by Spark and decides the vocabulary,
the shares within clusters and those within buckets. The network learns from every token of all documents,
``PASSES`` times: each partition takes gradient steps over its whole texts from the same weights, and the
weights it ends with, times its tokens, are added up in a tree and averaged for the next pass. What a step
needs of its places is laid out and sorted for some 100,000 of them at once, and words are cut, counted and
looked up by Arrow, a few megabytes of texts at a time. Clusters come from the neighbours of all tokens,
counted the same way. Only such sums of a fixed size reach the driver; the model has a fixed size and is sent
to all tasks. Texts are stored once as symbols of 16 bits, which the passes read. The vocabulary is ranked
within parts of the words first, so a bounded number of rows is merged. Scoring is one pass over the texts;
the words outside the vocabulary are shuffled to meet their counts, and their sums meet the texts by row.
No such word makes up more than 1 / ``VOCABULARY`` of all, so none is a hot key.

Defined results: words are runs other than white space, A-Z in lower case. Null and empty texts have no
tokens, score 0 and a null mean. Beyond a text's ends stands a blank symbol. Null ids are kept,
repeated rows scored each, other columns ignored. An empty corpus gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from salesloom.llm.common import ship
from salesloom.operators.staging import stage

VOCABULARY = 8192
BUCKETS = 512
SYMBOLS = VOCABULARY + BUCKETS
BLANK = SYMBOLS
#: Tokens on either side, size of an embedding and of the hidden layer, clusters.
SIDE = 3
WIDTH = 16
HIDDEN = 32
CLUSTERS = 64
#: Frequent symbols whose nearness decides clusters.
SIGNS = 48
#: Passes over all documents; places in a row and such rows in a gradient step; tokens laid out at once.
PASSES = 2
RUN = 64
RUNS = 8
#: Steps whose places are sorted at once.
SORTED = 256
LAID = 1 << 17
#: Parts in which words are ranked; tasks that add up the partitions' sums.
PARTS = 32
BRANCHES = 16
#: Tokens scored at once, so that they stay in a core's cache; bytes of texts cut into words at once.
BLOCK = 1 << 11
CUT = 1 << 22
#: Bytes of words whose checksums are taken together; what a byte does to a crc32.
SHORT = 24
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, (CRC >> 1) ^ np.uint32(0xEDB88320), CRC >> 1)
_ONES = np.ones(max(CLUSTERS, RUNS * (RUN + 2 * SIDE)), np.float32)
#: Logits of a larger size are shifted before they are raised to powers.
LARGE = 80

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("row", pa.int64()),
        ("n_tokens", pa.int64()),
        ("log_prob", pa.float64()),
        ("rare", pa.list_(pa.binary())),
    ]
)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, A-Z in lower case, as bytes; the number of words of each text."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar(None, texts.type), texts)
    words = pc.ascii_split_whitespace(texts)
    return words.flatten().cast(pa.binary()), pc.fill_null(pc.list_value_length(words), 0).to_numpy().astype(np.int64)


def checksums(words: pa.Array) -> np.ndarray:
    """The crc32 of each word: a byte of all words at a time, of long words by themselves."""
    _, ends, data = words.buffers()
    if not len(words) or data is None:
        return np.zeros(len(words), np.int64)
    ends, data = np.frombuffer(ends, np.int32)[words.offset :][: len(words) + 1], np.frombuffer(data, np.uint8)
    at, n = ends[:-1].astype(np.int64), np.diff(ends)
    order = np.argsort(-np.minimum(n, SHORT + 1).astype(np.int16), kind="stable")
    longer = len(words) - np.cumsum(np.bincount(np.minimum(n, SHORT + 1), minlength=SHORT + 2))  # words longer than each length
    at, sums = at[order], np.full(len(words), 0xFFFFFFFF, np.uint32)
    for k in range(SHORT):
        some = sums[: longer[k]]
        some[:] = CRC[(some ^ data[at[: longer[k]] + k]) & 255] ^ (some >> 8)
    found = np.empty(len(words), np.int64)
    found[order] = sums ^ 0xFFFFFFFF
    for i in order[: longer[SHORT]]:
        found[i] = zlib.crc32(data[ends[i] : ends[i + 1]])
    return found


def symbols_of(words: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Symbol of each word; the words outside the vocabulary, in their order."""
    found = pc.fill_null(pc.index_in(words, vocabulary), -1).to_numpy().astype(np.int64)
    rare = words.filter(pa.array(found < 0))
    found[found < 0] = VOCABULARY + checksums(rare) % BUCKETS
    return found, rare


@dataclass
class Model:
    vocabulary: list[bytes]
    cluster: np.ndarray  # of each symbol
    share: np.ndarray  # log share of each symbol in its cluster
    embed: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    buckets: np.ndarray  # log count of each bucket
    counts: DataFrame | None = field(default=None)  # (word, n), where it is stored

    def __getstate__(self) -> dict:
        return self.__dict__ | {"counts": None}

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def encode(self, text: bytes) -> np.ndarray:
        words, _ = words_of(pa.array([text], pa.binary()).view(pa.string()))
        return symbols_of(words, pa.array(self.vocabulary, pa.binary()))[0]

    def token_log_probs(self, tokens: np.ndarray, padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Log-probability of each token, given where it stands in ``padded``."""
        found = np.empty(len(tokens), np.float64)
        for at in range(0, len(tokens), BLOCK):
            here, target = places[at : at + BLOCK], tokens[at : at + BLOCK]
            logits = self.forward(padded, here)
            own = logits[np.arange(len(here)), self.cluster[target]]
            found[at : at + BLOCK] = own - np.log(np.exp(logits) @ _ONES[:CLUSTERS]) + self.share[target]
        return found

    def forward(self, padded: np.ndarray, here: np.ndarray) -> np.ndarray:
        """Logits of the clusters at each place, up to a number for each place."""
        first = here.min() - SIDE
        sums = _side_sums(self.embed.take(padded[first : here.max() + SIDE + 1], 0))
        h = _hidden(sums.take(here - first - SIDE, 0), sums.take(here - first + 1, 0), self.hidden, self.hidden_bias)
        return _logits(h, np.concatenate([self.out, self.out_bias[None]]))

    def score(self, texts: list[bytes]) -> list[tuple[int, float]]:
        """(number of tokens, summed log-probability up to the bucket) of each text."""
        return self.score_encoded([self.encode(t) for t in texts])

    def score_encoded(self, texts: list[np.ndarray]) -> list[tuple[int, float]]:
        tokens, padded, places, ends = lay_out(texts)
        sums = np.concatenate(([0.0], np.cumsum(self.token_log_probs(tokens, padded, places))))
        starts = np.concatenate(([0], ends[:-1]))
        return [(int(b - a), float(sums[b] - sums[a])) for a, b in zip(starts, ends)]


def _side_sums(embedded: np.ndarray) -> np.ndarray:
    """The sum of each place's embedding and of the ``SIDE`` - 1 that follow."""
    n = len(embedded) - SIDE + 1
    sums = embedded[:n].copy()
    for k in range(1, SIDE):
        sums += embedded[k : k + n]
    return sums


def _hidden(left: np.ndarray, right: np.ndarray, hidden: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The hidden layer of each place, and a one, which the output's bias is multiplied by."""
    sums = left @ hidden[:WIDTH]
    sums += right @ hidden[WIDTH:]
    sums += bias
    h = np.ones((len(sums), HIDDEN + 1), np.float32)
    np.tanh(sums, out=h[:, :HIDDEN])
    return h


def _logits(h: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Logits up to a number for each place, so that their powers are in range; ``out`` ends with the bias."""
    logits = h @ out
    if (_ONES[: len(out)] @ np.abs(out)).max() > LARGE:  # the hidden layer is between -1 and 1
        logits -= logits.max(1, keepdims=True)
    return logits


def lay_out(docs: list[np.ndarray]):
    """All tokens, the same with blanks between documents, each token's place there, documents' ends."""
    gap = np.full(SIDE, BLANK, np.int64)
    parts, places, at = [gap], [], SIDE
    for d in docs:
        parts += [d, gap]
        places.append(np.arange(at, at + len(d)))
        at += len(d) + SIDE
    tokens = np.concatenate([np.empty(0, np.int64), *docs])
    return tokens, np.concatenate(parts), np.concatenate([np.empty(0, np.int64), *places]), np.cumsum([len(d) for d in docs])


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents: counted in each batch of texts, then added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _cut(batches):
            found = words_of(part.column(0))[0].value_counts()
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long")
    return parts.groupBy(F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


def _cut(batches: Iterator[pa.RecordBatch], text: int = 0) -> Iterator[pa.RecordBatch]:
    """The batches in slices of whole texts, some ``CUT`` bytes each."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, before + CUT, "right")))
            yield batch.slice(at, end - at)
            at = end


def most_frequent(counts: DataFrame, most: int) -> list[Row]:
    """The ``most`` words of (word, n) by count, then by spelling: ranked within parts, then merged."""
    part = Window.partitionBy("part").orderBy(F.desc("n"), "word")
    parts = counts.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(PARTS)))
    first = stage(parts.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= most), "lm_frequent")
    return first.select("word", "n").coalesce(1).orderBy(F.desc("n"), "word").limit(most).collect()


def blocks_of(texts: Iterator[np.ndarray], size: int) -> Iterator[list[np.ndarray]]:
    """Whole texts in lists of at least ``size`` tokens; the last may have fewer."""
    held, n = [], 0
    for t in texts:
        if len(t):
            held.append(t.astype(np.int64))
            n += len(t)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def neighbours(texts: Iterator[np.ndarray]) -> np.ndarray | None:
    """How often each symbol stands near each of the ``SIGNS`` most frequent ones, and near any other."""
    size = SYMBOLS * (SIGNS + 1)
    counts = None
    for docs in blocks_of(texts, LAID):
        tokens, padded, places, _ = lay_out(docs)
        near = np.minimum(padded, SIGNS)  # the vocabulary is ordered by count
        at = np.concatenate([tokens * (SIGNS + 1) + near[places + k] for k in range(-SIDE, SIDE + 1) if k])
        found = np.bincount(at, minlength=size).astype(np.float64)
        counts = found if counts is None else counts + found
    return counts


def _clusters(counts: np.ndarray) -> np.ndarray:
    """Cluster of each symbol, by k-means on the frequent symbols that stand around it."""
    seen = counts.sum(1)
    mean = counts.sum(0) / max(1.0, float(seen.sum()))
    points = np.sqrt((counts + 20 * mean) / (seen + 20)[:, None])
    order = np.argsort(-seen, kind="stable")
    centres = points[order[:CLUSTERS]].copy()
    for _ in range(10):
        near = (points @ centres.T * 2 - (centres**2).sum(1)).argmax(1)
        for c in range(CLUSTERS):
            inside = near == c
            if inside.any():
                centres[c] = np.average(points[inside], axis=0, weights=seen[inside] + 0.1)
    return near


def untrained(vocabulary: list[bytes], counts: np.ndarray, near: np.ndarray) -> Model:
    """``counts`` holds each symbol's count in the corpus, ``near`` its neighbours."""
    random = np.random.default_rng(11)
    small = lambda *shape: (random.standard_normal(shape) * 0.1).astype(np.float32)
    cluster = _clusters(near)
    smooth = counts + 0.5
    totals = np.bincount(cluster, smooth, CLUSTERS)
    return Model(
        vocabulary,
        cluster,
        np.log(smooth) - np.log(totals[cluster]),
        small(SYMBOLS + 1, WIDTH),
        small(2 * WIDTH, HIDDEN),
        np.zeros(HIDDEN, np.float32),
        small(HIDDEN, CLUSTERS),
        np.log((totals + 1) / (totals + 1).sum()).astype(np.float32),
        np.log(smooth[VOCABULARY:]),
    )


@dataclass
class Step:
    """The runs of a gradient step, one after the other, each with ``SIDE`` more places at either end.

    Nothing is predicted at the ends of runs and at blanks, which ``weigh`` nothing.
    """

    flat: np.ndarray  # symbols
    weigh: np.ndarray  # of the places but the outermost
    goal: np.ndarray  # where the powers of the right clusters are
    touched: np.ndarray  # the symbols, and a place of each
    first: np.ndarray
    many: np.ndarray  # which of them have more places, these places, and where a symbol's begin
    again: np.ndarray
    begin: np.ndarray


def _steps(runs: np.ndarray, cluster: np.ndarray) -> Iterator[Step]:
    """Steps of ``RUNS`` runs; the places of many of them are sorted by symbol at once."""
    whole = len(runs) // RUNS * RUNS
    upto = lambda found: np.concatenate(([0], np.cumsum(found.sum(1)))).tolist()
    cuts = [*range(0, whole, RUNS * SORTED), whole, len(runs)]
    for some in (runs[a:b] for a, b in zip(cuts, cuts[1:]) if b > a):
        flat = some.reshape(-(-len(some) // RUNS), -1)
        real = np.zeros(some.shape, bool)
        real[:, SIDE:-SIDE] = some[:, SIDE:-SIDE] != BLANK
        real = real.reshape(flat.shape)[:, SIDE:-SIDE]
        weigh = (real / real.sum(1, keepdims=True)).astype(np.float32)
        at = np.flatnonzero(real)
        goal = at % real.shape[1] * CLUSTERS + cluster.take(flat[:, SIDE:-SIDE].ravel().take(at))
        order = np.argsort(flat.astype(np.int16), axis=1, kind="stable")  # by radix, for 16 bits
        ranked = flat.ravel().take(order + np.arange(0, flat.size, flat.shape[1])[:, None])
        edge = np.ones((len(flat), flat.shape[1] + 1), bool)
        edge[:, 1:-1] = ranked[:, 1:] != ranked[:, :-1]
        starts = edge[:, :-1]
        more = ~(starts & edge[:, 1:])
        heads, places = np.flatnonzero(starts), np.flatnonzero(more)
        touched, first, again = ranked.ravel().take(heads), order.ravel().take(heads), order.ravel().take(places)
        many, begin = np.flatnonzero(more.ravel().take(heads)), np.flatnonzero(starts.ravel().take(places))
        a, b, c, d = upto(real), upto(starts), upto(more), upto(starts & more)
        for k in range(len(flat)):
            symbols, places, groups = slice(b[k], b[k + 1]), slice(c[k], c[k + 1]), slice(d[k], d[k + 1])
            yield Step(
                flat[k], weigh[k], goal[a[k] : a[k + 1]], touched[symbols], first[symbols],
                many[groups] - b[k], again[places], begin[groups] - c[k],
            )


def _parts(dense: np.ndarray) -> list[np.ndarray]:
    """The weights of both layers, which lie one after the other: ``out`` ends with its bias."""
    a, b = 2 * WIDTH * HIDDEN, (2 * WIDTH + 1) * HIDDEN
    return [dense[:a].reshape(-1, HIDDEN), dense[a:b], dense[b:].reshape(-1, CLUSTERS)]


def _step(weights: list[np.ndarray], dense: list[np.ndarray], square: np.ndarray, slopes: list[np.ndarray], step: Step) -> None:
    """One Adagrad step. As all runs lie in one row, the neighbours of all places are a shifted view.

    ``weights`` and ``slopes`` are views of the arrays of ``dense``: weights, squares and slopes of both layers.
    """
    embed, hidden, hidden_bias, out = weights
    to_hidden, to_bias, to_out = slopes
    n = len(step.weigh)
    sums = _side_sums(embed.take(step.flat, 0))
    left, right = sums[:n], sums[SIDE + 1 :]
    h = _hidden(left, right, hidden, hidden_bias)
    p = _logits(h, out)
    np.exp(p, out=p)
    p *= (step.weigh / (p @ _ONES[:CLUSTERS]))[:, None]
    p.reshape(-1)[step.goal] -= np.float32(1 / len(step.goal))
    back = p @ out[:HIDDEN].T
    back *= 1 - h[:, :HIDDEN] ** 2
    wide = np.zeros_like(sums)
    np.matmul(back, hidden[:WIDTH].T, out=wide[:n])
    wide[SIDE + 1 :] += back @ hidden[WIDTH:].T
    each = np.zeros((len(step.flat), WIDTH), np.float32)
    for k in range(SIDE):
        each[k : k + len(wide)] += wide
    slope = each.take(step.first, 0)
    if len(step.many):
        slope[step.many] = np.add.reduceat(each.take(step.again, 0), step.begin, axis=0)
    sizes = square.take(step.touched, 0)
    sizes += slope * slope
    square[step.touched] = sizes
    slope /= np.sqrt(sizes, out=sizes)
    slope *= 0.1
    embed[step.touched] -= slope
    np.matmul(left.T, back, out=to_hidden[:WIDTH])
    np.matmul(right.T, back, out=to_hidden[WIDTH:])
    np.matmul(_ONES[:n], back, out=to_bias)
    np.matmul(h.T, p, out=to_out)
    whole, squares, every = dense
    squares += every * every
    whole -= 0.1 * every / np.sqrt(squares)


def learn(model: Model, squares: list[np.ndarray], texts: Iterator[np.ndarray], seed: tuple) -> np.ndarray | None:
    """Steps over all the texts; the weights and squares after them, times the tokens they come from.

    An embedding counts by how often its symbol was there, so partitions without it do not blur it.
    """
    random = np.random.default_rng(seed)
    embed, square = model.embed.copy(), squares[0].copy()
    dense = [np.concatenate([w.ravel() for w in some]) for some in (model.weights()[1:], squares[1:])]
    dense.append(np.empty_like(dense[0]))
    weights, slopes = [embed, *_parts(dense[0])], _parts(dense[2])
    seen, n = np.zeros(SYMBOLS + 1), 0
    for docs in blocks_of(texts, LAID):
        padded = lay_out(docs)[1]
        runs = -(-(len(padded) - 2 * SIDE) // RUN)
        laid = np.full(runs * RUN + 2 * SIDE, BLANK, np.int64)
        laid[: len(padded)] = padded
        rows = np.lib.stride_tricks.sliding_window_view(laid, RUN + 2 * SIDE)[::RUN][random.permutation(runs)]
        for step in _steps(rows, model.cluster):
            _step(weights, dense, square, slopes, step)
        seen += np.bincount(padded, minlength=SYMBOLS + 1)
        n += sum(map(len, docs))
    if not n:
        return None
    parts = [[n], seen]
    parts += [(embed * seen[:, None]).ravel(), (square * seen[:, None]).ravel()]
    cuts = np.cumsum([w.size for w in model.weights()[1:]])[:-1]
    for w, s in zip(*(np.split(d, cuts) for d in dense[:2])):
        parts += [w * n, s * n]
    return np.concatenate(parts).astype(np.float64)


def _averaged(model: Model, squares: list[np.ndarray], sums: np.ndarray) -> None:
    """Put the averages of what partitions learned into the model; symbols nobody saw stay."""
    n, seen, at = sums[0], sums[1 : SYMBOLS + 2], SYMBOLS + 2
    for i, (w, s) in enumerate(zip(model.weights(), squares)):
        by = np.broadcast_to(np.maximum(seen, 1)[:, None] if i == 0 else n, w.shape)
        known = np.broadcast_to(seen[:, None] > 0 if i == 0 else True, w.shape)
        for whole in (w, s):
            whole[known] = (sums[at : at + w.size].reshape(w.shape) / by)[known]
            at += w.size


def add_up(tokens: DataFrame, gather: Callable[[Iterator[np.ndarray]], np.ndarray | None]) -> np.ndarray | None:
    """The sum of what ``gather`` makes of each partition's texts: numbers of one length, added in a tree."""

    def row(sums: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = (np.frombuffer(t, np.int16) for batch in batches for t in batch.column(0).to_pylist())
        sums = gather(texts)
        if sums is not None:
            yield row(sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for part in batch.column(0):
                part = np.frombuffer(part.as_buffer(), np.float64)
                sums = part.copy() if sums is None else sums + part
        if sums is not None:
            yield row(sums)

    some = tokens.mapInArrow(each, "sums binary").repartition(BRANCHES).mapInArrow(total, "sums binary")
    got = stage(some, "lm_sums").coalesce(1).mapInArrow(total, "sums binary").collect()
    return np.frombuffer(got[0]["sums"], np.float64) if got else None


def encoded(docs: DataFrame, vocabulary: list[bytes], text_col: str = "text") -> DataFrame:
    """Each document's symbols, 16 bits each."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(sent.value, pa.binary())
        for part in _cut(batches):
            words, n = words_of(part.column(0))
            symbols = symbols_of(words, vocabulary)[0].astype(np.int16)
            found = [t.tobytes() for t in np.split(symbols, np.cumsum(n)[:-1])]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "tokens binary")


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count all words and their neighbours, then fit over all documents, ``PASSES`` times."""
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    counts = stage(word_counts(docs, text_col), "lm_word_counts")
    bucket = F.crc32(F.col("word").cast("binary")) % BUCKETS
    in_buckets = dict(counts.groupBy(bucket.alias("bucket")).agg(F.sum("n")).collect())
    top = most_frequent(counts, VOCABULARY)
    vocabulary = [r["word"].encode() for r in top]
    totals = np.zeros(SYMBOLS)
    totals[: len(top)] = [r["n"] for r in top]
    for b, n in in_buckets.items():
        totals[VOCABULARY + b] = n
    for word, r in zip(vocabulary, top):
        totals[VOCABULARY + zlib.crc32(word) % BUCKETS] -= r["n"]
    tokens = stage(encoded(docs, vocabulary, text_col), "lm_tokens")
    near = add_up(tokens, neighbours)
    near = np.zeros(SYMBOLS * (SIGNS + 1)) if near is None else near
    model = untrained(vocabulary, totals, near.reshape(SYMBOLS, SIGNS + 1))
    squares = [np.full_like(w, 1e-3) for w in model.weights()]
    for k in range(PASSES):
        sent = context.broadcast((model, squares))
        # bound now: the loop's names change
        one_pass = lambda texts, sent=sent, k=k: learn(*sent.value, texts, (11, k, TaskContext.get().partitionId()))
        sums = add_up(tokens, one_pass)
        if sums is not None:
            _averaged(model, squares, sums)
        sent.unpersist()
    model.counts = counts
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_prob (summed) and mean_log_prob of each document."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        vocabulary = pa.array(model.vocabulary, pa.binary())
        for part in _cut(batches, 2):
            words, n = words_of(part.column(2))
            symbols, rare = symbols_of(words, vocabulary)
            ends = np.cumsum(n)
            total = [s for _, s in model.score_encoded(np.split(symbols, ends[:-1]))]
            outside = np.flatnonzero(symbols >= VOCABULARY)
            upto = np.searchsorted(outside, np.concatenate(([0], ends)))
            # the words' own counts come in by the join
            buckets = np.concatenate(([0.0], np.cumsum(model.buckets[symbols[outside] - VOCABULARY])))
            total -= buckets[upto[1:]] - buckets[upto[:-1]]
            rare = pa.ListArray.from_arrays(pa.array(upto, pa.int32()), rare)
            columns = [part.column(0), part.column(1), pa.array(n), pa.array(total), rare]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text")
    )
    scored = stage(
        texts.mapInArrow(run, "doc_id long, row long, n_tokens long, log_prob double, rare array<binary>"), "lm_scored"
    )
    rare = scored.select("row", F.explode("rare").alias("word")).withColumn("word", F.col("word").cast("string"))
    own = F.log(F.coalesce(F.col("n").cast("double"), F.lit(0.5)))
    # the same join at every size: both sides grow with the texts
    sums = rare.join(model.counts.hint("merge"), "word", "left").groupBy("row").agg(F.sum(own).alias("own"))
    whole = scored.drop("rare").join(sums, "row", "left")
    return whole.select(
        "doc_id", "n_tokens", (F.col("log_prob") + F.coalesce("own", F.lit(0.0))).alias("log_prob")
    ).withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
