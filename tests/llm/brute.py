"""Plain versions of the contracts, written apart from the operators."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, r, n < 20 or 100 * r > 30 * n)


def base_secrets(text):
    text = text or ""
    rules = [(re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12, "assign"),
             (re.compile(r"AKIA[A-Z0-9]+"), 0, 18, "access"), (re.compile(r"[0-9a-f]+"), 0, 16, "hex")]
    found = sorted((m.start(), k, m.end(), name) for k, (p, g, least, name) in enumerate(rules) for m in p.finditer(text) if len(m[g]) >= least)
    return Counter(f[3] for f in found), hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in found).encode()).hexdigest()


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(rows):
    """doc_id -> smallest doc_id reachable by links of 80 % Jaccard."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            lists[x].append(i)
    seen = set()
    for ids in lists.values():
        for a in range(len(ids)):
            for b in range(a):
                pair = (ids[b], ids[a])
                if pair not in seen and root(pair[0]) != root(pair[1]):
                    seen.add(pair)
                    x, y = sets[pair[0]], sets[pair[1]]
                    if 100 * len(x & y) >= 80 * len(x | y):
                        p, q = sorted(map(root, pair))
                        parent[q] = p
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeats(rows, k=50):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256)."""
    first = {}
    data = {i: (t or "").encode() for i, t in rows}
    for i in sorted(data):
        for p in range(len(data[i]) - k + 1):
            first.setdefault(data[i][p:p + k], i)
    out = {}
    for i, b in data.items():
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - k + 1):
            if first[b[p:p + k]] < i:
                gone[p:p + k] = True
        runs = int(np.count_nonzero(np.diff(gone, prepend=False) & gone)) if len(b) else 0
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[i] = (len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
