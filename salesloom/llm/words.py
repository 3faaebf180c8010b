"""Token ids of texts by a word-level tokenizer file, with each distinct word encoded once."""

from __future__ import annotations

import os
import string
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

_MARKS = string.punctuation
#: Letters below this are composed and have lower-case forms of one letter.
LATIN_END = "\u0250"
_PROBES = ("word", "hello", "straße", "élève", "ñandú", "čeština", "xqzvw")
_SIGNS = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_OTHERS = [b for b in range(256) if b not in _SIGNS]
#: The sign for each byte in byte-level vocabularies: itself if printable, else one after 255.
_BYTE_SIGNS = {b: chr(b) for b in _SIGNS} | {b: chr(256 + i) for i, b in enumerate(_OTHERS)}
#: Words remembered by a Python worker; beyond that it starts anew.
REMEMBERED = 1_000_000


def blocks(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes of text each, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
        yield at, stop
        at = stop


class WordIds:
    """Encode texts with a tokenizer that lower-cases, drops white space and never looks across it.

    For such a tokenizer the ids of a text are those of its words, one after the other. Ids come as
    little-endian unsigned 32-bit integers.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        # Spark runs a task per core; threads of its own would only get in each other's way
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.remembered = remembered
        #: Whether lower-case Latin letters go straight to the model; tried, not assumed.
        self.plain = all(
            self._merged(w) == self.tokenizer.encode(w, add_special_tokens=False).ids for w in _PROBES
        )
        self.ids: dict[str, bytes] = {"": b""}

    def _merged(self, word: str) -> list[int]:
        """Ids of a word that needs no normalising and no splitting: the model's merges alone."""
        if not word.isascii():
            word = "".join([_BYTE_SIGNS[b] for b in word.encode()])
        return [token.id for token in self.tokenizer.model.tokenize(word)]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text; null counts as empty.

        Words are split off and numbered by Arrow, so that Python sees each distinct word of a batch
        once; numpy then puts their ids in the places of the words.
        """
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)  # the tokenizer does so too, but after special tokens
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        numbered = split.flatten().dictionary_encode()
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = set(words).difference(self.ids)
        if len(self.ids) + len(new) > self.remembered:
            self.ids = {"": b""}
            new = set(words).difference(self.ids)
        self._learn(new)
        ids = [self.ids[w] for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        pool, starts = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(sizes) - sizes
        order = numbered.indices.to_numpy()
        each = sizes[order]
        ends = np.concatenate(([0], np.cumsum(each)))
        flat = pool[np.arange(ends[-1]) + np.repeat(starts[order] - ends[:-1], each)]
        bounds = split.offsets.to_numpy()
        for a, b in zip(*(ends[x - bounds[0]] for x in (bounds[:-1], bounds[1:]))):
            yield flat[a:b].tobytes()

    def _learn(self, words: set[str]) -> None:
        """Encode ``words``; those that differ in case or in marks at the end share their stem's ids."""
        ids, shared, new = self.ids, [], set()
        for word in words:
            stem = word.rstrip(_MARKS)
            # a run of marks after a letter is a piece of its own; "<" may begin a special token
            if not stem or not stem[-1].isalpha() or stem[-1] >= LATIN_END or "<" in word:
                new.add(word)
                continue
            tail = word[len(stem) :]
            if stem.isascii():
                stem = stem.lower()
            if tail:
                shared.append((word, stem, tail))
                new.add(stem)
                new.add(tail)
            else:
                new.add(stem)
                if stem != word:
                    shared.append((word, stem, ""))
        self._encode(new.difference(ids))
        ids.update((word, ids[stem] + ids[tail] if tail else ids[stem]) for word, stem, tail in shared)

    def _encode(self, words: set[str]) -> None:
        if self.plain:
            rest = []
            for word in words:
                if word.isalpha() and max(word) < LATIN_END and word == word.lower():
                    self.ids[word] = _little(self._merged(word))
                else:
                    rest.append(word)
        else:
            rest = list(words)
        for at in range(0, len(rest), 4096):
            some = rest[at : at + 4096]
            encoded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.ids.update((w, _little(e.ids)) for w, e in zip(some, encoded))


def _little(ids: list[int]) -> bytes:
    """Unsigned 32-bit integers, little-endian."""
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()
