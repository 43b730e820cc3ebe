"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import defaultdict

WHITE = "[\x20\x09-\x0D]"


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def exact(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[re.sub(WHITE, "", text or "")].append((-len(text or ""), doc))
    out = {}
    for key, members in groups.items():
        keep = min(members)[1]
        for _, doc in members:
            out[doc] = (keep, len(members), doc == keep, hashlib.sha256(key.encode()).hexdigest())
    return out


def shingle_sets(rows):
    sets = {}
    for doc, text in rows:
        w = re.findall(WHITE.replace("[", "[^") + "+", small(text))
        sets[doc] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return sets


def components(rows):
    sets = shingle_sets(rows)
    root = {d: d for d in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    lists = defaultdict(list)
    for d, s in sets.items():
        for key in s:
            lists[key].append(d)
    pairs = {(a, b) for docs in lists.values() for a in docs for b in docs if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in sets}


def repeats(rows, size=50):
    first = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        for k in range(len(raw) - size + 1):
            first.setdefault(raw[k:k + size], doc)
    out = {}
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - size + 1):
            if first[raw[k:k + size]] < doc:
                gone[k:k + size] = b"\1" * size
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out
