"""Plain forms of what the operators compute."""

import hashlib
import math
import re
from collections import Counter, defaultdict


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))


def near_components(rows, size, percent):
    """(doc_id, set size, smallest doc_id reachable) of rows with distinct ids."""
    sets = [shingle_set(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    held = defaultdict(list)
    for i, mine in enumerate(sets):
        shared = Counter(j for s in mine for j in held[s])
        for s in mine:
            held[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(mine) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(rows, items, length=13):
    """(words, hit words, sorted item ids) per row."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(length, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows[tuple(w[k : k + n])].add("" if item is None else str(item))
    sizes = {len(w) for w in windows}
    out = []
    for _, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if items_here := windows.get(tuple(w[k : k + n])):
                    hit.update(range(k, k + n))
                    found |= items_here
        out.append((len(w), len(hit), sorted(found)))
    return out


def sha256(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def _digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(row):
    return _digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def _tree(leaves):
    """(root, per leaf the (left, right) siblings of each level)."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_digest(*levels[-1][k : k + 3]) for k in range(0, len(levels[-1]), 3)])
    proofs = []
    for at in range(len(leaves)):
        steps = []
        for nodes in levels[:-1]:
            first = at // 3 * 3
            steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + 3])))
            at //= 3
        proofs.append(steps)
    return levels[-1][0], proofs


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0] is not None, row[0] or 0, leaf_digest(row), row[0]))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    root, above = _tree([trees[s][0] for s in sources])
    out = []
    for s, rest in zip(sources, above, strict=True):
        for x, steps in zip(sorted(by_source[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            out.append((x[3], x[2], trees[s][0], root, steps + rest))
    return out


def ranking(rows, items, k):
    """(item, rank, doc_id, score) of rows (doc_id, text) for items (item_id, text)."""
    texts = [(i, Counter(words(t))) for i, t in rows]
    texts = [(i, c, c.total()) for i, c in texts if c]
    n_docs, n_words = len(texts), sum(n for _, _, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    out = []
    for item, text in items:
        asked, scores = {t for t in words(text) if df[t]}, []
        for i, c, n in texts:
            m = 50 + (50 * n * n_docs) // n_words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in asked
                if c[t]
            )
            if score > 0:
                scores.append((-score, i is not None, i or 0, i))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return out
