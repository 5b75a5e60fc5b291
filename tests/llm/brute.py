"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

UP = {c: c + 32 for c in range(65, 91)}
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def top_k(vectors, k, every, scale):
    ints = {}
    for i, v in vectors:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints[i] = [math.floor(scale * float(x)) for x in v]
    out = []
    for q, a in ints.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints.items() if i != q and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def shingles(text, k):
    w = SPACE.findall((text or "").translate(UP))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_duplicates(rows, k, percent):
    """(doc_id, n_shingles, component_id, kept), by counting what every pair shares."""
    sets = [(d, shingles(t, k)) for d, t in rows]
    classes = defaultdict(list)
    for n, (d, s) in enumerate(sets):
        if s and d is not None:
            classes[s].append(n)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(a, b):
        parent[find(a)] = find(b)

    by_doc = defaultdict(list)
    for n, (d, s) in enumerate(sets):
        if d is not None and s:
            by_doc[d].append(n)
    for group in [*classes.values(), *by_doc.values()]:
        for n in group[1:]:
            union(group[0], n)
    reps = list(classes)
    holders = defaultdict(list)
    for c, s in enumerate(reps):
        for x in s:
            holders[x].append(c)
    for c, s in enumerate(reps):
        shared = Counter(o for x in s for o in holders[x] if o > c)
        for o, both in shared.items():
            if 100 * both >= percent * (len(s) + len(reps[o]) - both):
                union(classes[s][0], classes[reps[o]][0])
    least = {}
    for n, (d, s) in enumerate(sets):
        if d is not None and s:
            r = find(n)
            least[r] = min(least.get(r, d), d)
    out = []
    for n, (d, s) in enumerate(sets):
        c = None if d is None else least[find(n)] if s else d
        out.append((d, len(s), c, c is None or d == c))
    return out


def base_places(text, phrases):
    """(n_words, starts of all places, labels)."""
    w = ALNUM.findall((text or "").translate(UP))
    starts, labels = [], set()
    for phrase, label in phrases:
        p = phrase.split()
        found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        starts += found
        if found:
            labels.add(label)
    return len(w), starts, labels


def contamination(docs, bench, window=13):
    """(doc, words, words hit, items, SHA-256 of the items, contaminated, longest match)."""
    items = defaultdict(set)
    whole = []
    for i, t in bench:
        w = ALNUM.findall((t or "").translate(UP))
        if i is None or not w:
            continue
        whole.append(w)
        for j in range(max(1, len(w) - window + 1)):
            items[tuple(w[j : j + window])].add(str(i))
    lengths = sorted({len(x) for x in items})
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(UP))
        hit, found, longest = set(), set(), 0
        for n in lengths:
            for j in range(len(w) - n + 1):
                x = tuple(w[j : j + n])
                if x in items:
                    hit.update(range(j, j + n))
                    found |= items[x]
        for v in whole if hit else []:
            # words that match from each pair of places on
            run = [0] * (len(v) + 1)
            for j in range(len(w) - 1, -1, -1):
                run = [run[m + 1] + 1 if w[j] == v[m] else 0 for m in range(len(v))] + [0]
                longest = max(longest, max((r for r in run if r >= min(window, len(v))), default=0))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w), longest))
    return out


def targets(sizes, most=3):
    """Target of each source, by sharing again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total = sum(sizes.values())
    target = dict.fromkeys(names, 0.0)
    open_, left = set(names), float(total)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            for s in open_:
                target[s] = level * weight[s]
            break
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def page_lines(html):
    t = re.sub(r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", "\n", html or "")
    t = re.sub(r"(?s)<[^>]*>", "\n", t)
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = t.replace(a, b)
    return [y for x in re.sub(r"[ \t\r\f]*\n[ \t\r\n\f]*", "\n", t).split("\n") if (y := x.strip(" "))]


def edit_distance(a, b):
    """Edits with swaps of neighbours (restricted)."""
    d = [[max(i, j) if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]
