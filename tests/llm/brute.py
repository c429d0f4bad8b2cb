"""Plain single-process versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def license_base(text):
    w = words(text)
    found = []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        found += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    starts = [i for i, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def tie(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def jaccard(docs, num=90, den=100, size=3):
    """docs: (id, text) -> {id: (n, component)}."""
    sets = {}
    for i, t in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOWER)) if x]
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    uf = Sets()
    both = defaultdict(int)
    for g, ids in where.items():
        ids = sorted(ids)
        for x in range(len(ids)):
            for y in ids[x + 1:]:
                both[ids[x], y] += 1
    for (a, b), o in both.items():
        if den * o >= num * (len(sets[a]) + len(sets[b]) - o):
            uf.tie(a, b)
    return {i: (len(s), uf.find(i)) for i, s in sets.items()}


ASSIGN = re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret_base(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    out.sort()
    kinds = [o[2] for o in out]
    return (*(kinds.count(k) for k in ("assign", "access", "hex")), sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in out)))


def suffixes(docs, size=50):
    """docs: (id, text) -> {id: (n_bytes, n_removed, n_spans, sha)}; ids are distinct."""
    first = {}
    raw = {i: (t or "").encode() for i, t in docs}
    for i in sorted(raw):
        b = raw[i]
        for p in range(len(b) - size + 1):
            first.setdefault(b[p:p + size], i)
    out = {}
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - size + 1):
            if first[b[p:p + size]] < i:
                gone[p:p + size] = True
        edge = int(np.sum(gone[1:] & ~gone[:-1]) + gone[0])
        out[i] = (len(b), int(gone.sum()), edge, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def url_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    best = None
    for h, p, v in RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, best


def cosine_links(rows, least=0.95):
    """rows: (id, vector) -> {id: (n_links, component)}; ids are distinct."""
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v is not None and len(v) and all(x is not None for x in v)]
    ok = [(i, v) for i, v in ok if np.isfinite(v).all() and v.any()]
    out = {i: [0, i] for i, _ in rows}
    uf = Sets()
    by = defaultdict(list)
    for i, v in ok:
        by[len(v)].append((i, v / np.linalg.norm(v)))
    for part in by.values():
        x = np.stack([v for _, v in part])
        near = x @ x.T >= least
        np.fill_diagonal(near, False)
        for k, (i, _) in enumerate(part):
            out[i][0] = int(near[k].sum())
            for j in np.flatnonzero(near[k]):
                uf.tie(i, part[j][0])
    return {i: (n, uf.find(i)) for i, (n, _) in out.items()}


def hits(text, items, window=10):
    w = words(text)
    gone = [False] * len(w)
    found = set()
    for item, body in items:
        b = words(body)
        k = min(window, len(b))
        known = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i:i + k]) in known:
                found.add(str(item))
                gone[i:i + k] = [True] * k
    return len(w), sum(gone), len(found), sha(",".join(sorted(found)))


def lines(docs, min_sites, min_chars):
    """docs: (id, text, site) -> [(id, n_lines, n_removed, sha)], first document kept."""
    sites, first = defaultdict(set), {}
    for i, t, s in docs:
        for x in (t or "").split("\n"):
            x = x.strip(" ")
            if len(x) >= min_chars and s is not None:
                sites[x].add(s)
                if i is not None:
                    first[x] = min(first.get(x, i), i)
    out = []
    for i, t, _ in docs:
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(x.strip(" ")) >= min_chars and len(sites[x.strip(" ")]) >= min_sites and first.get(x.strip(" ")) != i)]
        out.append((i, len(every), len(every) - len(kept), sha("\n".join(kept))))
    return out
