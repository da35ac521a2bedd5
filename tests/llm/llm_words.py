"""Plain re-statements that the tests compare with."""

from __future__ import annotations

import re

_LOWER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None, lower: bool = True) -> list[str]:
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(_LOWER) if lower else text)


def grouped(links, nodes) -> dict:
    """Smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
