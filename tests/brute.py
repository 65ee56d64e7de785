"""Slow, plain versions of the operators, written apart from them, for small fixtures."""

from __future__ import annotations

import hashlib

import numpy as np


def pairwise(x):
    x = np.asarray(x, dtype=np.float64)
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))


def knn(x, k):
    d = pairwise(x)
    n = len(d)
    return {
        i: [(j, d[i, j]) for j in sorted((j for j in range(n) if j != i), key=lambda j: (d[i, j], j))[:k]]
        for i in range(n)
    }


def reachability(x, min_samples):
    d = pairwise(x)
    n = len(d)
    k = min(min_samples, n - 1)
    core = np.array([np.sort(np.delete(d[i], i))[k - 1] for i in range(n)])
    return np.maximum(d, np.maximum(core[:, None], core[None, :])), core


def kruskal(w):
    """Edges of the least spanning tree in the total order (w, a, b)."""
    n = len(w)
    tree = list(range(n))
    out = []
    for weight, a, b in sorted((w[a, b], a, b) for a in range(n) for b in range(a + 1, n)):
        if tree[a] != tree[b]:
            old, new = tree[b], tree[a]
            tree = [new if t == old else t for t in tree]
            out.append((a, b, weight))
    return out


def hdbscan(x, min_cluster_size, min_samples):
    """Top-down: take the heaviest edge away, again and again."""
    w, _ = reachability(x, min_samples)
    n = len(w)
    if n < min_cluster_size:
        return [-1] * n
    edges = kruskal(w)

    def parts(members, kept):
        near = {m: [] for m in members}
        for a, b, _ in kept:
            near[a].append(b)
            near[b].append(a)
        seen, groups = set(), []
        for m in members:
            if m in seen:
                continue
            stack, group = [m], []
            seen.add(m)
            while stack:
                v = stack.pop()
                group.append(v)
                for u in near[v]:
                    if u not in seen:
                        seen.add(u)
                        stack.append(u)
            groups.append(group)
        return groups

    density = lambda weight: 1.0 / max(weight, 1e-12)
    clusters = []  # birth, members, children, leaving {point: density}

    def grow(members, kept, birth):
        me = len(clusters)
        clusters.append({"birth": birth, "members": list(members), "children": [], "leave": {}})
        members, kept = list(members), sorted(kept, key=lambda e: (e[2], e[0], e[1]))
        while kept:
            _, _, weight = kept.pop()
            groups = parts(members, kept)
            big = [g for g in groups if len(g) >= min_cluster_size]
            if len(big) == 2:
                for g in sorted(big):
                    inside = set(g)
                    for p in g:
                        clusters[me]["leave"][p] = density(weight)
                    child = grow(g, [e for e in kept if e[0] in inside], density(weight))
                    clusters[me]["children"].append(child)
                return me
            gone = set(members) - set(big[0]) if big else set(members)
            for p in gone:
                clusters[me]["leave"][p] = density(weight)
            if not big:
                return me
            members = big[0]
            inside = set(members)
            kept = [e for e in kept if e[0] in inside]
        return me

    grow(range(n), edges, 0.0)
    best, keep = {}, {}
    for c in range(len(clusters) - 1, -1, -1):
        own = sum(v - clusters[c]["birth"] for v in clusters[c]["leave"].values())
        under = sum(best[k] for k in clusters[c]["children"])
        keep[c] = own >= under - 1e-9 * abs(under) and c != 0
        best[c] = max(own, under)
    labels = [-1] * n
    stack, chosen = [0], []
    while stack:
        c = stack.pop()
        if keep[c]:
            chosen.append(clusters[c]["members"])
        else:
            stack.extend(clusters[c]["children"])
    for number, members in enumerate(sorted(chosen, key=min)):
        for p in members:
            labels[p] = number
    return labels


def silhouette(x, labels):
    d = pairwise(x)
    labels = np.asarray(labels)
    s = []
    for i in range(len(d)):
        own = labels == labels[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels.tolist()) - {labels[i]})
        s.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(s))


def squared_silhouette(x, labels):
    """Mean silhouette with squared distances, pair by pair."""
    x, labels = np.asarray(x, float), np.asarray(labels)
    apart = ((x[:, None] - x[None]) ** 2).sum(2)
    values = []
    for i, own in enumerate(labels):
        mates = (labels == own) & (np.arange(len(x)) != i)
        outside = min(apart[i][labels == c].mean() for c in set(labels.tolist()) - {own})
        inside = apart[i][mates].mean() if mates.any() else 0.0
        worst = max(inside, outside)
        values.append((outside - inside) / worst if mates.any() and worst > 0 else 0.0)
    return float(np.mean(values))


def groups(labels):
    """Members of each label, noise left out, by least member."""
    out = {}
    for i, c in enumerate(labels):
        if c != -1:
            out.setdefault(c, []).append(i)
    return sorted(out.values())


def digest(seed, row_id):
    """Place of a row in a seeded sample."""
    return hashlib.md5(f"{seed}:{row_id}".encode()).hexdigest(), row_id
