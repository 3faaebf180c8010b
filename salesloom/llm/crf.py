"""A linear-chain conditional random field with two tags, in numpy: toxic or not."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np

#: Chains are at most this long; longer lines go on in the next chain.
CHAIN = 256
#: Size of the hashed feature table.
SLOTS = 1 << 16
#: Distinct words whose score a worker remembers.
REMEMBERED = 500_000
_EDGE = ".,;:!?\"'()[]{}<>«»„“”’…-–—*_#"


def features(word: str) -> tuple[str, ...]:
    """The word in lower case without punctuation, its beginnings and its end."""
    bare = word.lower().strip(_EDGE)
    found = ["w=" + bare]
    for n in (3, 4, 5):
        if len(bare) > n:
            found.append(f"p={bare[:n]}")
    if len(bare) > 3:
        found.append("s=" + bare[-3:])
    return tuple(found)


def slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % SLOTS for f in features(word)]


def chains(text: str) -> list[list[str]]:
    """The words of each line, long lines in pieces."""
    found = []
    for line in text.split("\n"):
        words = line.split()
        found += [words[at : at + CHAIN] for at in range(0, len(words), CHAIN)]
    return found


def _padded(lengths: np.ndarray, most: int = 1 << 18):
    """Groups of chains of like length: (chains, index into the flat tokens, mask), one step a row."""
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and lengths[order[stop]] * (stop - at + 1) <= most:
            stop += 1
        some = order[at:stop]
        steps = np.arange(lengths[some[-1]])[:, None]
        mask = steps < lengths[some]
        yield some, np.where(mask, starts[some] + steps, 0), mask
        at = stop


@dataclass
class Crf:
    """Scores are for the toxic tag; the other tag's are 0. ``move`` is indexed [from, to], 1 toxic."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.float32))
    bias: float = -4.0
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    known: dict[str, float] = field(default_factory=dict)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "move": self.move, "known": {}}

    def scores(self, words: list[str]) -> np.ndarray:
        """Emission score of each word."""
        new = set(words).difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = set(words)
        weights, bias = self.weights, self.bias
        for word in new:
            self.known[word] = float(weights[slots(word)].sum()) + bias
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def marginals(self, scores: np.ndarray, lengths: np.ndarray, expect: bool = False):
        """Probability of the toxic tag per token, by forward-backward over all chains at once.

        Both passes hold the odds toxic : clean. With ``expect`` also the expected tag pairs.
        """
        result = np.zeros(len(scores))
        pairs = np.zeros((2, 2))
        (oo, ot), (to, tt) = np.exp(self.move)
        for _, index, mask in _padded(lengths):
            odds = np.where(mask, np.exp(np.clip(scores[index], -30, 30)), 1.0)
            steps = len(odds)
            ahead = np.empty_like(odds)
            ahead[0] = odds[0]
            for t in range(1, steps):
                ahead[t] = odds[t] * (ahead[t - 1] * tt + ot) / (ahead[t - 1] * to + oo)
            behind = np.ones_like(odds)
            for t in range(steps - 2, -1, -1):
                x = odds[t + 1] * behind[t + 1]
                behind[t] = np.where(mask[t + 1], (tt * x + to) / (ot * x + oo), 1.0)
            both = ahead * behind
            result[index[mask]] = (both / (1 + both))[mask]
            if expect and steps > 1:
                here, x = ahead[:-1], odds[1:] * behind[1:]
                parts = np.stack([np.full_like(x, oo), ot * x, to * here, tt * here * x])
                parts /= parts.sum(0)
                pairs += (parts * mask[1:]).sum((1, 2)).reshape(2, 2)
        return (result, pairs) if expect else result


def fit(texts: list[list[list[str]]], tagged: list[np.ndarray], passes: int = 6, batch: int = 400) -> Crf:
    """Fit on documents (chains of words) with 0/1 tags per word, by adaptive gradient steps."""
    lines = [c for doc in texts for c in doc]
    lengths = np.array([len(c) for c in lines], np.int64)
    model = Crf()
    if not len(lines):
        return model
    tags = np.concatenate(tagged).astype(np.float64)
    rows: dict[str, int] = {}
    tokens = np.array([rows.setdefault(w, len(rows)) for c in lines for w in c], np.int64)
    each = [slots(w) for w in rows]
    width = max(map(len, each))
    table = np.array([s + [SLOTS] * (width - len(s)) for s in each], np.int64)  # SLOTS: no feature
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    weights, seen = np.zeros(SLOTS + 1), np.full(SLOTS + 1, 1e-2)
    bias, bias_seen, move_seen = model.bias, 1e-2, np.full((2, 2), 1e-2)
    random = np.random.default_rng(7)
    for _ in range(passes):
        order = random.permutation(len(lines))
        for at in range(0, len(order), batch):
            some = order[at : at + batch]
            index = np.concatenate([np.arange(starts[i], starts[i] + lengths[i]) for i in some])
            size = lengths[some]
            used = table[tokens[index]]
            scores = weights[used].sum(1) + bias
            found, pairs = model.marginals(scores, size, expect=True)
            miss = tags[index] - found
            slope = np.bincount(used.ravel(), np.repeat(miss, width), SLOTS + 1) - 1e-3 * weights
            slope[SLOTS] = 0
            seen += slope**2
            weights += 0.5 * slope / np.sqrt(seen)
            bias_seen += miss.sum() ** 2
            bias += 0.5 * miss.sum() / np.sqrt(bias_seen)
            inside = np.ones(len(index), bool)
            inside[np.cumsum(size) - 1] = False
            left = np.flatnonzero(inside)
            was, then = tags[index][left].astype(int), tags[index][left + 1].astype(int)
            real = np.bincount(2 * was + then, minlength=4).reshape(2, 2)
            slope = real - pairs - 1e-2 * model.move
            move_seen += slope**2
            model.move = model.move + 0.1 * slope / np.sqrt(move_seen)
    model.weights, model.bias = weights[:SLOTS].astype(np.float32), float(bias)
    return model
