"""Plain Python versions of the contracts, a row at a time, to hold the operators against."""

import hashlib
import math
import re
import zlib

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, n=13):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(t))
    found = {}
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            found.setdefault(tuple(w[i : i + n]), set()).add(str(key))
    sizes = {len(k) for k in found}
    out = {}
    for key, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if own := found.get(tuple(w[i : i + size])):
                    hit |= set(range(i, i + size))
                    ids |= own
        out[key] = (len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit) and 20 * len(hit) >= len(w))
    return out


def secrets(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def shingle_set(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", folded(text))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def set_components(docs, share=85):
    sets = {k: shingle_set(t) for k, t in docs}
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = [k for k in sorted(sets) if sets[k]]
    for i, a in enumerate(keys):
        for b in keys[:i]:
            common = len(sets[a] & sets[b])
            if 100 * common >= share * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


def jaccard(a, b, n=5):
    def s(t):
        w = t.lower().split()
        return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    x, y = s(a), s(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def edited(docs):
    """`docs` in order of the key, null texts empty."""
    out = {}
    for (key, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        k = len(text) // 4
        out[key] = text[: len(text) - k] + after[:k]
    return out


def revisits(pages):
    first = {}
    for key, text in sorted(pages):
        data = (text or "").encode()
        if len(data) >= 100:
            first.setdefault(data, key)
    out = {}
    for key, text in pages:
        data = (text or "").encode()
        target = first.get(data, key)
        out[key] = (len(data), hashlib.sha256(data).hexdigest(), "response" if target == key else "revisit", None if target == key else target)
    return out


def minimax(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, total = (low + high) // 2, 1, 0
        for s in sizes:
            used, total = (used + 1, s) if total + s > mid else (used, total + s)
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def crc(text):
    return zlib.crc32((text or "").encode())


def bound(lengths, room):
    return math.ceil(sum(lengths) / room)
