"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, a):
        while self.up[a] != a:
            self.up[a] = self.up[self.up[a]]
            a = self.up[a]
        return a

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def removed_words(texts: dict[int, str | None], window: int) -> dict[int, tuple[int, list[bytes]]]:
    """(words, kept words) of each document."""
    words = {i: [w.encode() for w in SPACED.findall(t or "")] for i, t in texts.items()}
    least: dict[tuple, int] = {}
    for i in sorted(words):
        for j in range(len(words[i]) - window + 1):
            least.setdefault(tuple(words[i][j : j + window]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if least[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        out[i] = (len(w), [x for x, g in zip(w, gone, strict=True) if not g])
    return out


def shingles(text: str | None, k: int = 5) -> set[tuple[str, ...]]:
    w = SPACED.findall((text or "").translate(LOWER))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}


def jaccard_components(texts: dict[int, str | None], percent: int = 80, k: int = 5) -> tuple[dict[int, int], dict[int, int]]:
    sets = {i: shingles(t, k) for i, t in texts.items()}
    at = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            at[g].append(i)
    u = Union(sets)
    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in at[g] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                u.join(i, j)
    return {i: len(s) for i, s in sets.items()}, {i: u.find(i) for i in sets}


def contaminated(texts: dict, items: list[tuple], window: int = 10) -> dict:
    """(words, hit words, item ids) of each document."""
    holders = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        for j in range(max(1, len(w) - window + 1) if w else 0):
            holders[tuple(w[j : j + window])].add("null" if item is None else str(item))
    out = {}
    for i, text in texts.items():
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(x) for x in holders}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in holders:
                    hit.update(range(j, j + n))
                    found |= holders[tuple(w[j : j + n])]
        out[i] = (len(w), len(hit), sorted(found))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ["email", "ip", "card", "phone"]


def base_spans(t: str) -> list[tuple[str, int, int]]:
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(t):
        d = digits(m)
        if 12 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(t) if 9 <= len(digits(m)) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))
