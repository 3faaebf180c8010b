"""Plain versions of what SQL cannot express, over small inputs."""

from __future__ import annotations

import re

_WORDS = re.compile(r"[^ \t-\r]+").findall
_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> frozenset:
    words = _WORDS((text or "").translate(_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_components(docs: list[tuple], percent: int = 85) -> dict:
    """doc_id: (n_shingles, component_id), comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by_shingle: dict = {}
    for i, found in sets.items():
        for s in found:
            by_shingle.setdefault(s, []).append(i)
    seen = set()
    for group in by_shingle.values():
        for x, a in enumerate(group):
            for b in group[x + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        low, high = sorted((find(a), find(b)))
                        parent[high] = low
    return {i: (len(s), find(i)) for i, s in sets.items()}
