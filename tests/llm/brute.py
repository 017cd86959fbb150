"""Plain single-machine versions of the operators' results, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return [(a, b, k) for a, _, b, k in sorted(out)]


def shingles(text, size=5):
    w = words(text)
    return frozenset(tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def near(rows):
    """{doc_id: (class, rep, links)} of (id, text) rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    rep = {}
    for i in sorted(sets):
        rep.setdefault(sets[i], i)
    reps = sorted(i for s, i in rep.items() if s)
    links, parent = Counter(), {i: i for i in reps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in reps:
        for b in reps:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: ((root(rep[s]), rep[s], links[rep[s]]) if s else (i, i, 0)) for i, s in sets.items()}


def contained(docs, items, threshold=0.8):
    def parts(text):
        w = [x for x in re.split(r"[^\w]+|_", (text or "").lower()) if x]
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    held, asked = defaultdict(set), defaultdict(set)
    for i, t in docs:
        held[i] |= parts(t)
    for i, t in items:
        asked[i] |= parts(t)
    return {(d, i, len(h & q), len(q)) for d, h in held.items() for i, q in asked.items() if q and len(h & q) >= threshold * len(q) - 1e-9}


def quality_stats(text):
    text = text or ""
    w = words(text)
    lines = [s for s in text.split("\n") if words(s)]
    grams = Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    repeated = {k + d for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def bytes_removed(rows, length=50):
    """{row place: mask} of (id, text); a null id is later than all others."""
    least = {}
    order = [float("inf") if i is None else i for i, _ in rows]
    data = [(t or "").encode() for _, t in rows]
    for o, b in zip(order, data):
        for k in range(len(b) - length + 1):
            s = b[k:k + length]
            least[s] = min(least.get(s, o), o)
    out = []
    for o, b in zip(order, data):
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < o:
                gone[k:k + length] = [True] * length
        out.append((b, gone))
    return out


def words_removed(rows, length=35):
    each = [(t or "").encode().split() for _, t in rows]
    times = Counter(tuple(w[k:k + length]) for w in each for k in range(len(w) - length + 1))
    out = []
    for w in each:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if times[tuple(w[k:k + length])] > 1:
                gone[k:k + length] = [True] * length
        out.append((w, gone))
    return out
