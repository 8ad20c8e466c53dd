"""Plain versions of operators, shared by tests."""

import numpy as np

from civitas.llm.tiling import tokens


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def classes(texts, threshold=0.8):
    """Smallest id reachable by pairs of similar texts."""
    root = {d: d for d, _ in texts}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for n, (a, x) in enumerate(texts):
        for b, y in texts[:n]:
            u, v = x.lower().split(), y.lower().split()
            longest = max(len(u), len(v))
            if x == y or (longest and min(len(u), len(v)) >= threshold * longest
                          and 1 - plain_distance(u, v) / longest >= threshold - 1e-12):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: find(d) for d, _ in texts}


def cut_repeats(texts, window=50):
    first = {}
    data = [(d, t.encode()) for d, t in texts]
    for d, b in data:
        for i in range(len(b) - window + 1):
            w = b[i : i + window]
            first[w] = min(d, first.get(w, d))
    out = []
    for d, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if first[b[i : i + window]] < d:
                gone[i : i + window] = True
        out.append((d, bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")))
    return out


def brute_tiles(text, items, least=5, threshold=0.8):
    """Ids of items whose words common runs cover, the longest free run first."""
    words, hit = tokens(text), []
    for number, passage in items:
        own = tokens(passage)
        a, b, total = [False] * len(own), [False] * len(words), 0
        while True:
            best = (0, 0, 0)
            for i in range(len(own)):
                for j in range(len(words)):
                    k = 0
                    while (i + k < len(own) and j + k < len(words) and own[i + k] == words[j + k]
                           and not a[i + k] and not b[j + k]):
                        k += 1
                    best = max(best, (k, -i, -j))
            k, i, j = best[0], -best[1], -best[2]
            if k < min(least, len(own)):
                break
            a[i : i + k] = b[j : j + k] = [True] * k
            total += k
        if own and total >= threshold * len(own):
            hit.append(number)
    return hit
