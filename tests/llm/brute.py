"""Plain versions of the operators, for small tables only."""

from __future__ import annotations

import collections
import re

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: str | None, width: int) -> set:
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components(rows: list[tuple[int, str | None]], width: int, percent: int = 80) -> dict[int, int]:
    """doc_id -> smallest id of its component."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    holders = collections.defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(k)
    both = collections.Counter((a, b) for v in holders.values() for n, b in enumerate(v) for a in v[:n])
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a][1]) + len(sets[b][1]) - n):
            root[find(a)] = find(b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i: least[find(k)] for k, (i, _) in enumerate(sets)}


PATTERNS = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(digits: str) -> bool:
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def personal(text: str | None) -> list[str]:
    out = []
    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def removed(rows: list[tuple[int | None, str | None]], length: int) -> list[tuple[int | None, bytes, int, int]]:
    """(doc_id, kept bytes, removed bytes, removed runs), in the order of ``rows``."""
    least: dict[bytes, int] = {}
    for i, t in rows:
        b = (t or "").encode()
        if i is not None:
            for s in range(len(b) - length + 1):
                w = b[s : s + length]
                least[w] = min(i, least.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if i is not None and least[b[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, kept, sum(gone), len(re.findall(rb"\x01+", bytes(gone)))))
    return out


def water_filled(sizes: dict[str | None, int], share: float = 1.5, most: float = 2.0, weights: tuple = (3, 1, 2)) -> dict[str | None, float]:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = share * sum(sizes.values()), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        capped = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not capped:
            for s in open_:
                target[s] = left * weight[s] / total
            break
        for s in capped:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= capped
    return target
