"""Plain single-machine versions of the operators, for comparison."""

import re
from itertools import combinations

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base_measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    again = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in (i, i + 1, i + 2)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(again))


def shingles(text):
    w = words((text or "").translate(ASCII))
    if not w:
        return set()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs):
    """docs: [(id, text)] -> [(id, n_shingles, component id)], ids unique."""
    sets = {i: shingles(t) for i, t in docs}
    links = [(a, b) for a, b in combinations(sorted(sets), 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    found = components(sets, links)
    return sorted((i, len(s), found[i]) for i, s in sets.items())


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


def contamination(docs, items, window=10):
    """[(doc id, n_words, n_hit, item ids as strings)] for docs in order."""
    windows = {}
    for item, text in items:
        w = bench_words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = bench_words(text)
        hit, held = set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                found = windows.get(tuple(w[i:i + k]))
                if found:
                    hit |= set(range(i, i + k))
                    held |= found
        out.append((doc, len(w), len(hit), sorted(held)))
    return out


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """{source: target} by resharing the excess until none is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, open_, fixed = share * sum(sizes.values()), set(names), {}
    while True:
        rest = total - sum(fixed.values())
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not over:
            return fixed | {s: weight[s] * level for s in open_}
        fixed |= {s: most * sizes[s] for s in over}
        open_ -= over
