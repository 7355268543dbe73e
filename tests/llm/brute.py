"""Plain single-process versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def substring_dedup(rows, k=20):
    """{doc_id: (n_words, n_removed, kept_sha256)} for unique ids."""
    words = {d: SPACE_WORDS.findall(t or "") for d, t in rows}
    first = {}
    for d in sorted(words):
        for i in range(len(words[d]) - k + 1):
            first.setdefault(tuple(words[d][i: i + k]), (d, i))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i: i + k])] < (d, i):
                gone[i: i + k] = [True] * k
        kept = [x for x, g in zip(w, gone) if not g]
        out[d] = (len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shingles(text, k=5):
    w = SPACE_WORDS.findall((text or "").translate(LOWER))
    if not w:
        return set()
    return {tuple(w[i: i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def components(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def jaccard_join(rows, k=5, percent=75):
    """{doc_id: (n_shingles, component_id)} for unique ids."""
    sets = {d: shingles(t, k) for d, t in rows}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    common = defaultdict(int)
    for v in by.values():
        for i, a in enumerate(v):
            for b in v[i + 1:]:
                common[a, b] += 1
    links = [p for p, n in common.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    root = components(sets, links)
    return {d: (len(s), root[d]) for d, s in sets.items()}


def decontaminate(rows, items, k=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)} for unique ids."""
    def words(t):
        return ALNUM_WORDS.findall((t or "").translate(LOWER))

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - k + 1) if w else 0):
            windows[tuple(w[j: j + k])].add(i)
    sizes = {len(x) for x in windows}
    out = {}
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if (x := tuple(w[j: j + n])) in windows:
                    hit.update(range(j, j + n))
                    found |= windows[x]
        text = ",".join(sorted(map(str, found)))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(text.encode()).hexdigest(), bool(hit))
    return out


def quality_base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = SPACE_WORDS.findall(text)
    lines = [x for x in text.split("\n") if SPACE_WORDS.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i: i + 5])].append(i)
    twice = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice)


def mix_targets(sizes, weights, most=3):
    """{source: target}: the stops are met one round at a time."""
    total, stopped = sum(sizes.values()), {}
    while True:
        open_ = {s: w for s, w in weights.items() if s not in stopped}
        left = total - sum(stopped.values())
        now = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        above = {s: most * sizes[s] for s in now if now[s] > most * sizes[s]}
        if not above:
            return {**stopped, **now}
        stopped |= above


def collocations(rows, least=30, longest=4, top=2000):
    """Sorted (lang, rank, phrase, a, l, r, n, score) of (lang, text) rows."""
    found, total = defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    found[lang][tuple(w[i: i + m])] += 1
    out = []
    for lang, f in found.items():
        rated = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(100 * n >= 80 * a for q, n in f.items() if len(q) > len(p) and n >= least and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, total[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rated)[:top])]
    return sorted(out)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def _tree(nodes):
    """The root, and each node's path of (left siblings, right siblings)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        runs = [level[i: i + 3] for i in range(0, len(level), 3)]
        for x, i in enumerate(at):
            run = runs[i // 3]
            paths[x].append((run[: i % 3], run[i % 3 + 1:]))
        at, level = [i // 3 for i in at], [sha(*r) for r in runs]
    return level[0], paths


def merkle(rows):
    """{doc_id: (leaf, subroot, root, proof_sha256, folded_root, verified)} of (doc_id, source, lang, n_chars, text), unique ids."""
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0))
        trees[s] = _tree([leaf(r) for r in by[s]])
    if not order:
        return {}
    root, tops = _tree([trees[s][0] for s in order])
    out = {}
    for s, top in zip(order, tops):
        for r, path in zip(by[s], trees[s][1]):
            steps = path + top
            h = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                h = leaf((*r[:4], r[4].replace("\n", "")))
            for left, right in steps:
                h = sha(*left, h, *right)
            out[r[0]] = (leaf(r), trees[s][0], root, sha(*(x for a, b in steps for x in a + b)), h, h == root)
    return out
