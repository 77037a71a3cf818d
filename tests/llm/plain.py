"""Plain Python statements of what the operators compute, for small inputs."""

from __future__ import annotations

import re

LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def line_dedup(docs: list[tuple[int | None, str | None]], window: int = 3, long_words: int = 50) -> dict:
    """(id, text) to (text without later runs, lines, removed lines)."""
    order = sorted({(d, t) for d, t in docs if t is not None}, key=lambda x: -1 if x[0] is None else x[0])
    first: dict[tuple, tuple[int, int]] = {}

    def runs(n: int, text: str):
        lines = [(i, x) for i, x in enumerate(text.split("\n")) if x.strip(" ")]
        for size in range(1, window + 1):
            for k in range(len(lines) - size + 1):
                part = lines[k:k + size]
                if size == window or sum(x.count(" ") + 1 for _, x in part) >= long_words:
                    yield (n, part[0][0]), tuple(x for _, x in part), [i for i, _ in part]

    for n, (_, t) in enumerate(order):
        for place, run, _ in runs(n, t):
            first.setdefault(run, place)
    out = {(d, None): (None, 1, 0) for d, t in docs if t is None}
    for n, (d, t) in enumerate(order):
        gone = {i for place, run, at in runs(n, t) if first[run] != place for i in at}
        lines = t.split("\n")
        out[d, t] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(lines), len(gone))
    return out


def near_duplicates(docs: list[tuple[int | None, str | None]]) -> list[tuple[int, int, int]]:
    """(id, class id, links) per document, null ids as the least number."""
    sets = []
    for _, t in docs:
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(docs)
    links, parent = [0] * n, list(range(n))

    def find(a: int) -> int:
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    key = [-2**63 if d is None else d for d, _ in docs]
    least: dict[int, int] = {}
    for i in range(n):
        r = find(i)
        least[r] = min(least.get(r, key[i]), key[i])
    return [(key[i], least[find(i)], links[i]) for i in range(n)]
