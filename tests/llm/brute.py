"""The operators' results by plain loops over a few texts."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from rivulet.llm import maxent

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_components(docs):
    """doc_id -> (n_shingles, component_id) for (doc_id, text) rows."""
    sets = [(i, shingles(t)) for i, t in docs]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        least[find(k)].append(i)
    smallest = lambda k: min((i for i in least[find(k)] if i is not None), default=None)
    return sorted(
        ((i, len(s), smallest(k) if s else i) for k, (i, s) in enumerate(sets)), key=lambda r: tuple(map(str, r))
    )


def without_repeats(docs, length):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) for (doc_id, text) rows."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def unigram_scores(docs):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) for (doc_id, text) rows."""
    rows = [(i, words(t) + [None], zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0) for i, t in docs]
    counts = Counter(w for _, t, held in rows if not held for w in t)
    total, distinct = sum(counts.values()), len(counts)
    score = lambda t: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in t)
    return [(i, held, len(t), sum(counts[w] > 0 for w in t), total, score(t)) for i, t, held in rows]


def maxent_scores(docs, head):
    """(doc_id, n_tokens, score) for (doc_id, text) rows. Only the hashes of words and features are the operator's."""
    rows = []
    for i, t in docs:
        for _, _, place, found in maxent.tokens(pa.array([t or ""])):
            at = maxent.context_features(place, found, np.arange(len(found)))
            held = zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
            rows.append((i, held, [int(h) for h in found], [[int(f) for f in x] for x in at]))
    training = [(tokens, at) for _, held, tokens, at in rows if not held]
    counts = Counter(h for tokens, _ in training for h in tokens)
    total = sum(counts.values())
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    known = sorted((h for h in counts if counts[h] > 1), key=lambda h: (-counts[h], signed(h)))[:head]
    tail = known[1024:]
    of, member, before = {}, {}, 0
    for k, h in enumerate(known[:1024]):
        of[h], member[h] = k // 32, k % 32
    for h in tail:
        of[h] = 32 + before * 7 // sum(counts[x] for x in tail)
        before += counts[h]
    mass = Counter()
    for h in known:
        mass[of[h]] += counts[h]
    mass[39] = total - sum(mass.values()) + 0.1
    whole = sum(mass.values())
    low = lambda x: max(math.log(x), -60) if x > 0 else -60
    bias = [low(mass[c] / whole) for c in range(40)]
    inner = {c: [-60.0] * 32 for c in range(32)}
    for h in member:
        inner[of[h]][member[h]] = low(counts[h] / mass[of[h]])
    size = max(4096, int(total**0.5))
    outer_at = lambda x: [(f % size,) for f in x]
    inner_at = lambda x, c: [(c, (f >> 20) % (size // 16)) for f in x]
    weights, seen = {}, defaultdict(Counter)

    def chances(start, at):
        none = [0.0] * len(start)
        x = [b + sum(weights.get(a, none)[k] for a in at) for k, b in enumerate(start)]
        most = max(x)
        x = [math.exp(v - most) for v in x]
        return [v / sum(x) for v in x]

    def steps():
        for tokens, places in training:
            for h, x in zip(tokens, places):
                c = of.get(h, 39)
                yield bias, outer_at(x), c
                if c < 32:
                    yield inner[c], inner_at(x, c), member[h]

    for start, at, k in steps():
        for a in at:
            seen[a][k] += 1
    for pace in (0.5, 0.5):
        expected, starts = defaultdict(lambda: None), {}
        for start, at, _ in steps():
            p = chances(start, at)
            for a in at:
                starts[a] = start
                expected[a] = [x + y for x, y in zip(expected[a] or [0.0] * len(p), p)]
        moved = {}
        for a, sums in expected.items():
            old = weights.get(a, [0.0] * len(sums))
            prior = [60 * math.exp(b) + 1e-9 for b in starts[a]]
            moved[a] = [w + pace * math.log((seen[a][k] + prior[k]) / (sums[k] + prior[k])) for k, w in enumerate(old)]
        weights = moved
    outside = sum(n for h, n in counts.items() if h not in of) + 0.1 * (len(counts) - len(of) + 1)
    out = []
    for i, _, tokens, places in rows:
        score = 0.0
        for h, x in zip(tokens, places):
            c = of.get(h, 39)
            score += math.log10(chances(bias, outer_at(x))[c])
            if c < 32:
                score += math.log10(chances(inner[c], inner_at(x, c))[member[h]])
            elif c < 39:
                score += math.log10(counts[h] / mass[c])
            else:
                score += math.log10((counts[h] + 0.1) / outside)
        out.append((str(i), len(tokens), score))
    return out
