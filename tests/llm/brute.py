"""Plain versions of the operators, for small tables."""

import hashlib


def sha(x: bytes) -> str:
    return hashlib.sha256(x).hexdigest()


def suffix_dedup(rows, length=100):
    docs = sorted((d, (t or "").encode()) for d, t in rows)
    seen, out = set(), {}
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(t), sum(gone), spans, sha(kept))
    return out


def substring_dedup(rows, window=20):
    seen, out = set(), {}
    for d, t in sorted((d, (t or "").encode().split()) for d, t in rows):
        gone = [False] * len(t)
        for i in range(len(t) - window + 1):
            w = tuple(t[i : i + window])
            if w in seen:
                gone[i : i + window] = [True] * window
            seen.add(w)
        out[d] = (len(t), sum(gone), sha(b" ".join(w for w, g in zip(t, gone) if not g)))
    return out


def jaccard(rows, n=5):
    """doc_id -> (set size, least id reachable by links)."""
    sets = {}
    for d, t in rows:
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
        sets[d] = {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 5 * min(len(x), len(y)) >= 4 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 80 * (len(x) + len(y) - both):
                    p, q = sorted((root(a), root(b)))
                    up[q] = p
    return {d: (len(sets[d]), root(d)) for d in ids}
