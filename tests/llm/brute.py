"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def removed_substrings(rows, w=50):
    last = 1 << 62
    seen = {}
    for i, t in rows:
        b, k = (t or "").encode(), last if i is None else i
        for p in range(len(b) - w + 1):
            seen[b[p:p + w]] = min(seen.get(b[p:p + w], last), k)
    out = []
    for i, t in rows:
        b, k = (t or "").encode(), last if i is None else i
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - w + 1):
            if seen[b[p:p + w]] < k:
                gone[p:p + w] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rule_counts(t):
    t = t or ""
    words = WORD.findall(t)
    windows = list(zip(words, words[1:], words[2:]))
    count, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover),
            n < 50 or 100 * len(cover) > 50 * n)


def simhash(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def near_components(ids, fps, bits=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_secrets(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    text = ",".join(f"{['assign', 'access', 'hex'][k]}:{a}:{b}" for a, k, b in sorted(out))
    return tuple(sum(x[1] == k for x in out) for k in range(3)) + (hashlib.sha256(text.encode()).hexdigest(),)


def word_edits(a, b):
    """Fewest edits from word list a to any stretch of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)
