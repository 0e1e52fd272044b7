"""Plain versions of the operators over Python rows, to compare with."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def token_counts(docs):
    t = tokenizer()
    return sorted((d, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 512) for d, x in docs)


def pieces(docs, capacity=1024):
    t, out = tokenizer(), []
    for d, x in docs:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        lo, hi, k = 0, (len(ids) - 1) % capacity + 1, 0
        while lo < len(ids):
            out.append((d, k, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())))
            lo, hi, k = hi, hi + capacity, k + 1
    return sorted(out)


def removed(docs, length=50):
    first = {}
    for d, x in docs:
        if d is None:
            continue
        b = (x or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w not in first or d < first[w]:
                first[w] = d
    out = []
    for d, x in docs:
        b = (x or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        if d is not None:
            for i in range(len(b) - length + 1):
                if first[b[i:i + length]] < d:
                    gone[i:i + length] = True
        runs = int((gone[1:] < gone[:-1]).sum())
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=False) if not g)).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


def top(vectors, every=50, k=5):
    usable = [(i, np.floor(256 * np.asarray(v, float))) for i, v in vectors if i is not None and v and all(x is not None for x in v) and np.isfinite(np.asarray(v, float)).all()]
    out = []
    for q, a in usable:
        if q % every:
            continue
        best = sorted((-int(a @ b), i) for i, b in usable if i != q and len(b) == len(a))[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def base_scores(docs):
    def words(x):
        return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))

    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    c = Counter()
    for d, x in docs:
        if not held[d]:
            c.update(words(x))
            c[None] += 1
    n, v = sum(c.values()), len(c)
    out = []
    for d, x in docs:
        w = [*words(x), None]
        out.append((d, held[d], len(w), sum(c[t] > 0 for t in w), n, sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in w)))
    return sorted(out)


def fingerprint(x):
    from xxhash import xxh64_intdigest

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
    s = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxh64_intdigest(t.encode(), 42) for t in s]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h)) if h else 0


def simhash(docs):
    f = {}
    for d, x in docs:
        f.setdefault(fingerprint(x), []).append(d)
    prints = list(f)
    a = np.array(prints, np.uint64)
    up = list(range(len(a)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 2):
            x, y = root(i), root(int(j))
            up[max(x, y)] = min(x, y)
    low = defaultdict(lambda: math.inf)
    for i, p in enumerate(prints):
        low[root(i)] = min(low[root(i)], min(f[p]))
    return sorted((d, f"{p:016x}", low[root(i)]) for i, p in enumerate(prints) for d in f[p])
