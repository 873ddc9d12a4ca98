"""Plain Python versions of the operators' results, for small tables."""

import hashlib
import itertools
import re

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return SPACED.findall(text or "")


def alnum(text):
    return ALNUM.findall(lower(text))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text, k=3):
    words = spaced(lower(text))
    runs = [words[i:i + k] for i in range(len(words) - k + 1)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(n, linked):
    """Root (smallest index) of each of n items under a link test."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(n), 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(n)]


def components(rows, k=3, distance=2):
    """(doc_id, text) -> list of (fingerprint, component_id) in order."""
    fps = [simhash(t, k) for _, t in rows]
    roots = classes(len(rows), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= distance)
    low = {}
    for (doc, _), r in zip(rows, roots):
        if doc is not None:
            low[r] = min(low.get(r, doc), doc)
    return [(f, low.get(r)) for f, r in zip(fps, roots)]


def without_repeats(rows, width=13):
    """(doc_id, text) -> list of (n_words, n_removed, kept text)."""
    rank = lambda d: float("inf") if d is None else d
    low = {}
    for doc, text in rows:
        words = spaced(text)
        for i in range(len(words) - width + 1):
            key = tuple(words[i:i + width])
            low[key] = min(low.get(key, float("inf")), rank(doc))
    out = []
    for doc, text in rows:
        words, gone = spaced(text), set()
        for i in range(len(words) - width + 1):
            if low[tuple(words[i:i + width])] < rank(doc):
                gone.update(range(i, i + width))
        out.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def contamination(rows, items, width=10):
    """texts -> list of (n_words, n_hit, sorted item ids)."""
    windows = {}
    for item, text in items:
        words = alnum(text)
        if item is not None:
            for i in range(max(len(words) - width + 1, 1 if words else 0)):
                windows.setdefault(tuple(words[i:i + width]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for text in rows:
        words, hit, found = alnum(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                names = windows.get(tuple(words[i:i + n]))
                if names:
                    hit.update(range(i, i + n))
                    found |= names
        out.append((len(words), len(hit), sorted(found)))
    return out
