"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeats(rows):
    """Result of each (id, text): bytes, removed, spans, digest of what is kept."""
    first: dict[bytes, int] = {}
    for who, text in rows:
        data = (text or "").encode()
        if who is not None:
            for k in range(len(data) - 49):
                first[data[k : k + 50]] = min(who, first.get(data[k : k + 50], who))
    out = []
    for who, text in rows:
        data = (text or "").encode()
        mark = np.zeros(len(data), bool)
        if who is not None:
            for k in range(len(data) - 49):
                if first[data[k : k + 50]] < who:
                    mark[k : k + 50] = True
        kept = bytes(b for b, m in zip(data, mark, strict=True) if not m)
        spans = int((np.diff(np.concatenate([[0], mark.astype(int)])) == 1).sum())
        out.append((who, len(data), int(mark.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    words = _WORD.findall((text or "").translate(_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def jaccard(rows):
    """Result of each (id, text): size of the set and smallest id reachable."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = [i for i, (who, _) in enumerate(rows) if who is not None]
    for n, i in enumerate(known):
        for j in known[:n]:
            common = len(sets[i] & sets[j])
            linked = common and 100 * common >= 80 * len(sets[i] | sets[j])
            if (linked or rows[i][0] == rows[j][0]) and root(i) != root(j):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i in known:
        least[root(i)] = min(rows[i][0], least.get(root(i), rows[i][0]))
    return [
        (who, len(sets[i]), None if who is None else least[root(i)]) for i, (who, _) in enumerate(rows)
    ]


def edit_distance_in(pattern: bytes, text: bytes) -> int:
    """Fewest edits that turn `pattern` into some part of `text`."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def clusters(rows, k=8, rounds=10, width=64, scale=1024, seed="3"):
    """(id, cluster, distance, inertia of it, inertia, digest) of each usable (id, vector)."""
    import math

    kept = [
        (who, [math.floor(scale * x) for x in v])
        for who, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    def start(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centres = [v for _, v in sorted(kept, key=start)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        mine = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            own = [v for (_, v), c in zip(kept, mine, strict=True) if c == j]
            if own:
                centres[j] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(who, *nearest(v)[::-1]) for who, v in kept]
    total = sum(d for _, _, d in found)
    of = [sum(d for _, c, d in found if c == j) for j in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(who, c, d, of[c], total, names[c]) for who, c, d in found]


def word_counts(rows, every=97, least_length=5, least_count=3):
    import zlib
    from collections import Counter

    counts = Counter()
    for who, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if who is None else who}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def one_apart(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(counts, ratio=2):
    """(word, form, root, n, n_near, form_n) of each word."""
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    forms = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts.get(forms[w])))
    return out


def edited(rows):
    """(id, code points, digest of the edited text) of each (id, text)."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (who, text), (_, follower) in zip(order, order[1:] + order[:1], strict=True):
        text, follower = text or "", follower or ""
        half = len(text) // 2
        new = text[: len(text) - half] + follower[:half]
        out.append((who, len(text), hashlib.sha256(new.encode()).hexdigest(), text, new, follower))
    return out


def site_posteriors(rows):
    """(host rate, path rate, prior without the row itself) of each (host, path, probability)."""
    from collections import defaultdict

    def sums(key):
        out = defaultdict(lambda: [0, 0.0])
        for row in rows:
            out[key(row)][0] += 1
            out[key(row)][1] += row[2]
        return out

    def strength(groups):
        seen = sum(n * (good / n - prior) ** 2 for n, good, prior in groups)
        chance = sum(prior * (1 - prior) for _, _, prior in groups)
        scale = sum(n * prior * (1 - prior) for n, _, prior in groups)
        between = (seen - chance) / scale
        return min(max(1 / between - 1, 1.0), 1e6) if between > 1e-6 else 1e6

    hosts, paths = sums(lambda r: r[0]), sums(lambda r: r[:2])
    rate = sum(r[2] for r in rows) / len(rows)
    strong = strength([(n, good, rate) for n, good in hosts.values()])

    def host_rate(host, own=0.0, one=0):
        n, good = hosts[host]
        return (good - own + strong * rate) / (n - one + strong)

    near = strength([(n, good, host_rate(host)) for (host, _), (n, good) in paths.items()])

    def path_rate(host, path, own=0.0, one=0):
        n, good = paths[host, path]
        return (good - own + near * host_rate(host, own, one)) / (n - one + near)

    return [(host_rate(h), path_rate(h, p), path_rate(h, p, own, 1)) for h, p, own in rows]
