"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PRINTED = re.compile("[^\x20\x09-\x0d]+")


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def contamination(docs, items, span=10):
    """doc rows (doc_id, text) in order -> (doc_id, n_words, n_hit, sorted ids)."""
    windows = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(span, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[n][tuple(w[k : k + n])].add(str(item))
    out = []
    for doc, text in docs:
        w, hit, ids = ALNUM.findall(lower(text)), set(), set()
        for n, own in windows.items():
            for k in range(len(w) - n + 1):
                if found := own.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    ids |= found
        out.append((doc, len(w), len(hit), tuple(sorted(ids))))
    return out


def repeats(docs, length=100):
    """doc rows (doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, sha256 of the rest)."""
    earliest = {}
    for doc, text in docs:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            at = (doc is None, doc or 0, k)
            g = data[k : k + length]
            earliest[g] = min(earliest.get(g, at), at)
    out = []
    for doc, text in docs:
        data = (text or "").encode()
        gone = [False] * len(data)
        for k in range(len(data) - length + 1):
            if earliest[data[k : k + length]] < (doc is None, doc or 0, k):
                gone[k : k + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def measures(text):
    words = PRINTED.findall(text or "")
    grams = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {p for k in range(len(words) - 4) if grams[tuple(words[k : k + 5])] > 1 for p in range(k, k + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if PRINTED.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def shingles(text, n=5):
    w = ALNUM.findall(lower(text))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def links(docs, threshold=0.8):
    """doc rows (doc_id, text) -> rows (doc_id, class_id, n_links)."""
    sets = [shingles(t) for _, t in docs]
    n = len(docs)
    parent, counts = list(range(n)), [0] * n

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                counts[i] += 1
                counts[j] += 1
                parent[root(i)] = root(j)
    least = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(k)] = min(least.get(root(k), doc), doc)
    return [(doc, least.get(root(k)), counts[k]) for k, (doc, _) in enumerate(docs)]


def blank_components(docs, n=4, percent=80):
    """doc rows (doc_id, text) -> rows (doc_id, set size, least doc_id reachable)."""
    sets = []
    for _, text in docs:
        w = PRINTED.findall(lower(text))
        sets.append({tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc, _), x in zip(docs, label):
        if doc is not None:
            least[x] = min(least.get(x, doc), doc)
    return [(doc, len(s), least.get(x)) for (doc, _), s, x in zip(docs, sets, label)]


def search(docs, items, top):
    """Rows (item_id, rank, doc_id, score)."""
    terms = [ALNUM.findall(lower(text)) for _, text in docs]
    n_docs, total = sum(bool(t) for t in terms), sum(map(len, terms))
    tfs = [Counter(t) for t in terms]
    df = Counter(t for tf in tfs for t in tf)
    out = []
    for item, text in items:
        found = []
        for (doc, _), own, tf in zip(docs, terms, tfs):
            m = 100 - 25 + (25 * len(own) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in ALNUM.findall(lower(text)) if tf[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return out


def codes(rows, width, parts=4, entries=256, rounds=4):
    """Rows (vec_id, vector, label) -> rows (vec_id, label, codes, errors), and the final codebooks."""
    kept = []
    for vec, v, label in rows:
        if v and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(1024 * x) for x in v]
            kept.append((vec, label, [q[p * width // parts : (p + 1) * width // parts] for p in range(parts)]))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, b"".join(x.to_bytes(4, "little", signed=True) for part in r[2] for x in part)))
    books = [[r[2][p] for r in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for step in range(rounds + 1):
        found = [[nearest(r[2][p], books[p]) for p in range(parts)] for r in kept]
        if step == rounds:
            break
        for p in range(parts):
            own = defaultdict(list)
            for r, f in zip(kept, found):
                own[f[p][1]].append(r[2][p])
            books[p] = [[sum(c) // len(c) for c in zip(*own[e])] if own[e] else c for e, c in enumerate(books[p])]
    return [(vec, label, tuple(e for _, e in f), tuple(d for d, _ in f)) for (vec, label, _), f in zip(kept, found)], books


def toxic_features(text, kinds, stems):
    """Words, pairs with words left out and stems of a text, none of them hashed."""
    w = [x.encode() for x in ALNUM.findall(lower(text))]
    out = {("stem", k, x[:k]) for k in stems for x in w}
    for n, gap in kinds:
        for at in range(len(w) - n - gap + 1):
            out.add((n, gap, w[at], *w[at + gap + 1 : at + gap + n]))
    return out


def ftrl(rows, labels, epochs, alpha, beta, l1, l2):
    """rows of feature sets, one after another -> a function that gives a set's score."""
    z, n, b, zb, nb = defaultdict(float), defaultdict(float), 0.0, 0.0, 0.0

    def weight(k):
        return 0.0 if abs(z[k]) <= l1 else (math.copysign(l1, z[k]) - z[k]) / ((beta + math.sqrt(n[k])) / alpha + l2)

    def score(keys):
        return 1 / (1 + math.exp(-(sum(weight(k) for k in keys) + b)))

    for _ in range(epochs):
        for keys, label in zip(rows, labels):
            g = score(keys) - label
            for k, w in [(k, weight(k)) for k in keys]:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / alpha * w
                n[k] += g * g
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / alpha * b
            nb += g * g
            b = -zb / ((beta + math.sqrt(nb)) / alpha)
    return score
