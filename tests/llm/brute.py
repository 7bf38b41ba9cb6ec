"""Slow and plain versions of operators, for comparison."""

from __future__ import annotations

import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text: str | None, words: int) -> int:
    got = WORD.findall(lower_ascii(text or ""))
    if not got:
        return 0
    shingles = [" ".join(got[i : i + words]) for i in range(max(1, len(got) - words + 1))]
    values = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def components(ids: list, fps: list[int], radius: int) -> list:
    """Smallest id reachable from each row by links of at most ``radius`` bits."""
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least: dict[int, int | None] = {}
    for i, own in enumerate(ids):
        r = find(i)
        least[r] = min([x for x in (own, least.get(r)) if x is not None], default=None)
    return [least[find(i)] for i in range(len(ids))]
