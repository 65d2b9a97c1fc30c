"""Plain versions of the operators, for small tables."""

import regex


def shingles(text, n=5):
    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    return frozenset(zip(*[words[k:] for k in range(n)])) if len(words) >= n else frozenset([tuple(words)] if words else [])


def jaccard(rows, threshold=0.8):
    """rows: (id, text). Per row (class_id, copy_id, n_links)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    where = {}
    for k, s in enumerate(sets):
        seen = {}
        for g in s:
            for j in where.setdefault(g, []):
                seen[j] = seen.get(j, 0) + 1
            where[g].append(k)
        for j, common in seen.items():
            if common >= threshold * (len(s) + len(sets[j]) - common):
                links[k] += 1
                links[j] += 1
                parent[find(k)] = find(j)

    def least(members):
        ids = [rows[m][0] for m in members if rows[m][0] is not None]
        return min(ids) if ids else None

    groups, copies = {}, {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
        copies.setdefault(sets[k] or k, []).append(k)
    return [(least(groups[find(k)]), least(copies[sets[k] or k]), links[k]) for k in range(len(rows))]
