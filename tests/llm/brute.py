"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def fold(doc_id, mod: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % mod


# -- n-gram join --------------------------------------------------------------------------

def shingles(text: str | None, n: int = 5) -> set:
    w = words(lower_ascii(text or ""))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def linked(a: set, b: set) -> bool:
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def join_components(rows: list[tuple]) -> list[tuple]:
    """(id, n, component) of every (id, text)."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    links = [(i, j) for i in range(len(rows)) for j in range(i) if linked(sets[i], sets[j])]
    while changed:
        changed = False
        for i, j in links:
            if label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    least: dict = {}
    for (doc_id, _), k in zip(rows, label):
        if doc_id is not None:
            least[k] = min(least.get(k, doc_id), doc_id)
    return [(d, len(s), least.get(k) if s else d) for (d, _), s, k in zip(rows, sets, label)]


# -- mixing -------------------------------------------------------------------------------

def targets(sizes: dict, weights=(5, 2, 1), cap: float = 3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, active, out = float(sum(sizes.values())), set(order), {}
    while active:
        scale = left / sum(weight[s] for s in active)
        full = [s for s in active if scale * weight[s] > cap * sizes[s]]
        if not full:
            return out | {s: scale * weight[s] for s in active}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
            active.discard(s)
    return out


# -- quality rules ------------------------------------------------------------------------

def measures(text: str | None) -> tuple:
    t = text or ""
    w = words(t)
    windows = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated))


def critical(n: int, risk: float, level: float) -> int:
    total, best = 0.0, -1
    for k in range(n + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                          + k * math.log(risk) + (n - k) * math.log(1 - risk))
        if total > level:
            return best
        best = k
    return best


# -- language ID --------------------------------------------------------------------------

def grams(text: str) -> collections.Counter:
    out: collections.Counter = collections.Counter()
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text.lower())):
        out.update(word)
        padded = f"\x01{word}\x01"
        out.update(padded[i:i + 2] for i in range(len(padded) - 1))
        out.update(padded[i:i + 3] for i in range(len(padded) - 2))
    # neighbouring words share one boundary mark; both counts above hold it once each
    return out


def profile(counter: collections.Counter, size: int) -> dict:
    code = {g: sum(ord(c) << 21 * k for k, c in enumerate(g)) for g in counter}
    ranked = sorted(counter, key=lambda g: (-counter[g], code[g]))[:size]
    return {g: r for r, g in enumerate(ranked)}


def predict_language(profiles: dict[str, dict], text: str | None, size: int) -> tuple[str, float]:
    own = profile(grams(text or ""), size)
    if not own or not profiles:
        return "und", 0.0
    distance = {lang: sum(min(abs(p[g] - r), size) if g in p else size for g, r in own.items())
                for lang, p in profiles.items()}
    best = min(sorted(distance, key=str.encode), key=lambda x: distance[x])
    return best, 1 - distance[best] / (size * len(own))


# -- language model -----------------------------------------------------------------------

class KneserNey:
    def __init__(self, texts: list[str | None]):
        self.unigrams: collections.Counter = collections.Counter()
        self.bigrams: collections.Counter = collections.Counter()
        for t in texts:
            w = self.tokens(t)
            self.unigrams.update(w)
            self.bigrams.update(zip(["<start>", *w], w))
        self.contexts = collections.Counter(w for _, w in self.bigrams)
        self.total: collections.Counter = collections.Counter()
        self.kinds = collections.defaultdict(lambda: [0, 0, 0])
        for (u, _), c in self.bigrams.items():
            self.total[u] += c
            self.kinds[u][min(c, 3) - 1] += 1
        self.all_contexts, self.known = sum(self.contexts.values()), sum(self.unigrams.values())
        self.high, self.low = self.discounts(self.bigrams.values()), self.discounts(self.contexts.values())

        spread = sum(self.low[min(x, 3) - 1] for x in self.contexts.values())
        self.spread = spread / self.all_contexts if self.all_contexts else 1

    @staticmethod
    def tokens(text: str | None) -> list[str]:
        return [*words(lower_ascii(text or "")), "<end>"]

    @staticmethod
    def discounts(counts) -> tuple:
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if not all(n):
            return 0.5, 1.0, 1.5
        y = n[0] / (n[0] + 2 * n[1])
        return tuple(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3))

    def p(self, u: str, w: str) -> float:
        v, c = len(self.unigrams), self.contexts[w]
        below = (c - self.low[min(c, 3) - 1] if c else 0) / max(self.all_contexts, 1) + self.spread / (v + 1)
        if not self.total[u]:
            return below
        c = self.bigrams[u, w]
        own = (c - self.high[min(c, 3) - 1] if c else 0) / self.total[u]
        return own + sum(d * n for d, n in zip(self.high, self.kinds[u])) / self.total[u] * below

    def score(self, text: str | None) -> tuple:
        """n_tokens, n_known, base score, score"""
        w = self.tokens(text)
        n, v = self.known, len(self.unigrams)
        base = sum(math.log10((self.unigrams[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        return (len(w), sum(self.unigrams[x] > 0 for x in w), base,
                sum(math.log10(self.p(u, x)) for u, x in zip(["<start>", *w], w)))
