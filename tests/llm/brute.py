"""Plain Python versions of what the operators compute, for small fixtures."""

from __future__ import annotations

import re

import xxhash

SPACES = " \t\n\x0b\x0c\r"


def groups(nodes, edges):
    """The smallest node reachable from each node."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def lower_ascii(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def space_words(text):
    return re.findall(f"[^{SPACES}]+", text or "")


def simhash(text, k=3):
    words = space_words(lower_ascii(text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(prints, ids, max_bits=3):
    """Component id (smallest id) of each row, linking fingerprints within ``max_bits``."""
    n = range(len(prints))
    edges = [(i, j) for i in n for j in n if i < j and (prints[i] ^ prints[j]).bit_count() <= max_bits]
    root = groups(n, edges)
    least = {}
    for i in n:
        if ids[i] is not None:
            least[root[i]] = min(least.get(root[i], ids[i]), ids[i])
    return [least.get(root[i]) for i in n]


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def contamination(text, items, window=10):
    """Hit word numbers and item names."""
    words, hit, names = item_words(text), set(), set()
    for name, item in items:
        w = item_words(item)
        k = min(window, len(w))
        for i in range(len(w) - k + 1) if k else ():
            for j in range(len(words) - k + 1):
                if words[j : j + k] == w[i : i + k]:
                    hit |= set(range(j, j + k))
                    names.add("null" if name is None else str(name))
    return words, hit, names


def sainte_lague(weights, seats):
    """Seats dealt one by one to the highest quotient; ties to the smaller key."""
    got = {k: 0 for k, w in weights.items() if w > 0}
    for _ in range(seats if got else 0):
        best = min(got, key=lambda k: (-weights[k] / (2 * got[k] + 1), k))
        got[best] += 1
    return {k: got.get(k, 0) for k in weights}


def targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by source: shares of all words, held at ``most`` times the source, the excess shared again."""
    keys = sorted(k for k in sizes if k is not None) + [k for k in sizes if k is None]
    weight = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [k for k in keys if k not in held]
        if not free:
            break
        level = (total - sum(most * sizes[k] for k in held)) / sum(weight[k] for k in free)
        above = [k for k in free if weight[k] * level > most * sizes[k]]
        if not above:
            break
        held |= set(above)
    return {k: float(most * sizes[k]) if k in held else weight[k] * level for k in keys}


def base_secrets(text):
    """Base spans ``start, place, stop, value`` by kind."""
    text = text or ""
    out = []
    words = "|".join("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token"))
    key = "[aA][pP][iI]_?[kK][eE][yY]"
    for m in re.finditer(rf"""({words}|{key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), m[2]))
    for place, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        out += [(m.start(), place, m.end(), m[0]) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(out)


def pieces(word, vocabulary):
    """Greedy longest-match pieces; bytes where no piece fits."""
    n = 0
    while word:
        for k in range(len(word), 0, -1):
            if word[:k] in vocabulary:
                n, word = n + 1, word[k:]
                break
        else:
            n, word = n + len(word[0].encode()), word[1:]
    return n


class KneserNey:
    """Interpolated modified Kneser-Ney trigrams over lists of ids, straight from the formulas."""

    def __init__(self, texts, begin, size):
        from collections import Counter, defaultdict

        c3 = Counter()
        for ids in texts:
            x = [begin, begin, *ids]
            c3.update(zip(x, x[1:], x[2:], strict=False))
        c2 = Counter((v, w) for _, v, w in c3)
        c1 = Counter((w,) for _, w in c2)
        self.size, self.tables = size, []
        for counts in (c1, c2, c3):
            of = [sum(n == k for n in counts.values()) for k in range(1, 5)]
            if of[0] and of[1]:
                y = of[0] / (of[0] + 2 * of[1])
                d = [1 - 2 * y * of[1] / of[0], 2 - 3 * y * of[2] / of[1], 3 - 4 * y * of[3] / of[2] if of[2] else 2.0]
                d = [min(max(x, 0.05), k) for k, x in zip((0.95, 1.95, 2.95), d, strict=True)]
            else:
                d = [0.5, 0.75, 0.9]
            total, freed = defaultdict(int), defaultdict(float)
            for gram, n in counts.items():
                total[gram[:-1]] += n
                freed[gram[:-1]] += d[min(n, 3) - 1]
            self.tables.append((counts, d, total, freed))

    def p(self, w, context):
        counts, d, total, freed = self.tables[len(context)]
        low = self.p(w, context[1:]) if context else 1 / (self.size - 1)
        if not total.get(context):
            return low
        n = counts.get((*context, w), 0)
        return ((n - d[min(n, 3) - 1]) if n else 0) / total[context] + freed[context] / total[context] * low
