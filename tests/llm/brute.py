"""Plain versions of the operators for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def op8(docs, bench, width=10):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    wins = defaultdict(set)
    for i, t in bench:
        if i is not None and t is not None and (w := word(t)):
            for k in range(max(1, len(w) - width + 1)):
                wins[tuple(w[k : k + width])].add(str(i))
    out = []
    sizes = {len(w) for w in wins}
    for d, t in docs:
        w, hit, items = word(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in wins:
                    hit |= set(range(k, k + n))
                    items |= wins[x]
        out.append((d, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def fingerprint(t, n=3):
    w = words(lower(t))
    s = [" ".join(w[k : k + n]) for k in range(max(1, len(w) - n + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def op6(docs):
    fp = [fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{fp[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(docs)]


def op10(docs, width=13):
    first = {}
    for d, t in docs:
        w = words(t)
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            first[x] = min(d, first.get(x, d))
    out = []
    for d, t in docs:
        w, gone = words(t), set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < d:
                gone |= set(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def op4(docs, width=400):
    seen = Counter()
    data = [(d, (t or "").encode()) for d, t in docs]
    for _, t in data:
        seen.update(t[k : k + width] for k in range(len(t) - width + 1))
    out = []
    for d, t in data:
        gone, until, spans = bytearray(len(t)), 0, 0
        for k in range(len(t) - width + 1):
            if seen[t[k : k + width]] > 1:
                spans += k > until or not until
                for p in range(max(k, until), k + width):
                    gone[p] = 1
                until = k + width
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
