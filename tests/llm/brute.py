"""Plain Python versions of what the operators compute, for small inputs."""

import hashlib
import re
from collections import defaultdict


def lowered(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def shingles(text, width):
    w = re.findall(rb"[^\x20\x09-\x0D]+", lowered(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(width))))


def components(docs, width, percent):
    """doc_id -> (set size, least id reachable) for documents with ids."""
    sets = {d: shingles(t, width) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (len(sets[d]), find(d)) for d in ids}


def repeats(docs, width=50):
    """doc_id -> (n_bytes, n_removed, n_spans, digest of what is left); ids are distinct or null."""
    order = sorted(docs, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, {}
    for place, (d, text) in enumerate(order):
        data = (text or "").encode()
        cut = bytearray(len(data))
        rank = place if d is not None else 1 << 40
        for p in range(len(data) - width + 1):
            s = data[p: p + width]
            if first.setdefault(s, rank) < rank:
                cut[p: p + width] = b"\1" * width
        kept = bytes(b for b, c in zip(data, cut) if not c)
        out[d] = (len(data), sum(cut), len(re.findall(rb"\x01+", bytes(cut))), hashlib.sha256(kept).hexdigest())
    return out


def benchmark_hits(docs, items, window=13):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows, sizes = defaultdict(set), set()
    for item, text in items:
        w = word.findall(lowered(text))
        if w:
            k = min(window, len(w))
            sizes.add(k)
            for p in range(len(w) - k + 1):
                windows[tuple(w[p: p + k])].add(item)
    out = {}
    for d, text in docs:
        w = word.findall(lowered(text))
        hit, found = set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if tuple(w[p: p + k]) in windows:
                    found |= windows[tuple(w[p: p + k])]
                    hit.update(range(p, p + k))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))
    return out


def targets(rows, weights=(3, 1, 2), share=1.5, most=2.0):
    """(source, size) rows -> source -> target, by sharing the excess again until none is left."""
    total = defaultdict(int)
    for s, n in rows:
        total[s] += n
    order = sorted((s for s in total if s is not None), key=str.encode) + ([None] if None in total else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full = set()
    while True:
        rest = share * sum(total.values()) - sum(most * total[s] for s in full)
        open_weight = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and rest * weight[s] / open_weight > most * total[s]}
        if not over:
            break
        full |= over
    return {s: most * total[s] if s in full else rest * weight[s] / open_weight for s in order}
