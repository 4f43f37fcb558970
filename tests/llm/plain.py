"""Plain single-machine versions of the operators, written from their contracts."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, n: int, pieces: str = "the of and ing tion er on re an th") -> str:
    parts = pieces.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n))


def components(pairs, nodes):
    parent = {v: v for v in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {v: find(v) for v in nodes}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def jaccard_components(rows):
    """(doc_id, text) rows with distinct ids -> {doc_id: (n_shingles, component)}."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = components(pairs, ids)
    return {i: (len(sets[i]), label[i]) for i in ids}


def removed(rows, width=50):
    """(doc_id, text) rows -> list of (doc_id, n_bytes, n_removed, n_spans, kept hash), ids may repeat."""
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - width + 1) if i is not None else ():
            w = b[p : p + width]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1) if i is not None else ():
            if first[b[p : p + width]] < i:
                gone[p : p + width] = b"\1" * width
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def base_secrets(text):
    """Kind, start and end of the base spans, straight from the patterns."""
    text = text or ""
    found = []
    word = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found += [(m.start(), 0, m.end()) for m in word.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], s, e) for s, k, e in sorted(found)]


def best_edits(window: bytes, text: bytes) -> int:
    """Fewest edits between the window and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(window, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def water_fill(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    """{source: size} -> {source: target} by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    full, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**full, **share}
        full |= {s: most * sizes[s] for s in over}


def jump(key: int, shards: int) -> int:
    at, b = 0, -1
    key %= 1 << 64
    while at < shards:
        b = at
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        at = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def grouped(rows):
    out = defaultdict(list)
    for k, v in rows:
        out[k].append(v)
    return out


def periodic(words):
    """All runs (start, length, period) of a list of words, period by period."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((s, n, q) for (s, n), q in found.items())


def runs_row(doc_id, text):
    """The row of the query for one document, straight from its contract."""
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = periodic(words)
    gone = set()
    for s, size, q in found:
        gone.update(range(s + q, s + size))
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (doc_id, len(found), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def edits(word, alphabet):
    """All strings one insertion, deletion or replacement away."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + a + word[i + 1 :] for i in range(len(word)) for a in alphabet}
    out |= {word[:i] + a + word[i:] for i in range(len(word) + 1) for a in alphabet}
    return out - {word}


def one_apart(a, b):
    """Whether exactly one code point is put in, left out or replaced, by comparing both strings."""
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else len(b) - len(a) == 1 and a[k:] == b[k + 1 :])


def spelling(rows):
    """(doc_id, text) rows -> {word: (form, root, n, n_near, form_n)}."""
    counts = defaultdict(int)
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts.get(form[w]))
    return out


def exact(rows):
    """(doc_id, text) rows -> list of (doc_id, keep_id, group size, kept, hash), one row of each group kept."""
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, k, i))
    out = []
    for text, members in groups.items():
        first = min(members)
        out += [(m[4], first[4], len(members), m is first, hashlib.sha256(text.encode()).hexdigest()) for m in members]
    return out
