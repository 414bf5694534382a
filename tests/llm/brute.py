"""Plain Python versions of the operators, on lists of (doc_id, text)."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np


def words(text):
    return (text or "").encode().split()


def shingle_set(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def similar(docs, n=5, percent=80):
    """{doc_id: (class_id, n_links, n_copies)}; ids must differ."""
    sets = {d: shingle_set(t, n) for d, t in docs}
    nodes = collections.defaultdict(list)
    for d in sorted(sets):
        nodes[sets[d]].append(d)
    keys = [k for k in nodes if k]
    links = collections.defaultdict(set)
    label = {i: i for i in range(len(keys))}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(keys):
        for j in range(i):
            if 100 * len(a & keys[j]) >= percent * len(a | keys[j]):
                links[i].add(j)
                links[j].add(i)
                label[top(i)] = top(j)
    first = {}
    for i, k in enumerate(keys):
        first[top(i)] = min(first.get(top(i), nodes[k][0]), nodes[k][0])
    out = {d: (d, 0, 1) for d in nodes.get(frozenset(), [])}
    for i, k in enumerate(keys):
        for d in nodes[k]:
            out[d] = (first[top(i)], len(links[i]), len(nodes[k]))
    return out


def passages(docs, window=50):
    """[(doc_id, n_words, n_removed, kept words)]"""
    first = {}
    for d, t in sorted(docs):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = []
    for d, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), [x for x, g in zip(w, gone, strict=True) if not g]))
    return out


def sha(kept):
    return hashlib.sha256(b" ".join(kept)).hexdigest()


_BREAK = re.compile(r"\n(?:[\x20\x09-\x0D]*\n)?")
_WORD = re.compile(r"[^\x20\x09-\x0D]")


def line_runs(docs, min_lines=3, min_words=None):
    """[(doc_id, n_removed, new text)]; ids must differ."""
    split = {d: ([], []) if t is None else (_BREAK.split(t), _BREAK.findall(t)) for d, t in docs}
    seen, gone = set(), collections.defaultdict(set)
    for d in sorted(split):
        lines = split[d][0]
        for size in range(1 if min_words else min_lines, min_lines + 1):
            for i in range(len(lines) - size + 1):
                run = tuple(lines[i : i + size])
                long_enough = size == min_lines or sum(len(words(x)) for x in run) >= min_words
                if long_enough and all(_WORD.search(x) for x in run):
                    if run in seen:
                        gone[d].update(range(i, i + size))
                    seen.add(run)
    out = []
    for d, t in docs:
        lines, breaks = split[d]
        kept = [i for i in range(len(lines)) if i not in gone[d]]
        new = "".join(lines[i] + (breaks[i] if i != kept[-1] else "") for i in kept)
        out.append((d, len(gone[d]), new if gone[d] else t))
    return out


def base_failed(text):
    w = words(text)
    spots = collections.defaultdict(list)
    for i in range(len(w) - 2):
        spots[tuple(w[i : i + 3])].append(i)
    repeated = {p for at in spots.values() if len(at) > 1 for i in at for p in (i, i + 1, i + 2)}
    return len(w) < 50 or 100 * len(repeated) > 50 * len(w)


def nearest(vectors, query_ids, k):
    """{query_id: [(score, vec_id)]} over every usable vector of the query's length."""
    usable = {i: np.array(v, float) for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in query_ids:
        if q in usable:
            a = usable[q]
            scored = [
                (float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), i) for i, b in usable.items() if i != q and len(b) == len(a)
            ]
            out[q] = sorted(scored, key=lambda s: (-round(s[0], 12), s[1]))[:k]
    return out
