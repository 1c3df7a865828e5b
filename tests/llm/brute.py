"""Plain versions of the operators, for small fixtures."""

import hashlib
import re
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def groups(n, links):
    """Smallest place of each place's component."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(k) for k in range(n)]


def shingle_set(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def near_text(docs, size):
    """{place: (n_shingles, component id)} for (id, text) rows."""
    sets = [shingle_set(t, size) for _, t in docs]
    links = [
        (a, b)
        for a in range(len(docs))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    root = groups(len(docs), links)
    least = {}
    for k, r in enumerate(root):
        least[r] = min(least.get(r, docs[k][0]), docs[k][0])
    return sorted((docs[k][0], len(sets[k]), least[root[k]]) for k in range(len(docs)))


def near_vectors(rows):
    good = [k for k, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = []
    for a in good:
        for b in good:
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if a < b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links.append((a, b))
    n = Counter(k for pair in links for k in pair)
    root = groups(len(rows), links)
    least = {}
    for k, r in enumerate(root):
        least[r] = min(least.get(r, rows[k][0]), rows[k][0])
    return sorted((rows[k][0], n[k], least[root[k]]) for k in range(len(rows)))


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        c = int(c)
        if k % 2:
            c = 2 * c - 9 if c > 4 else 2 * c
        total += c
    return total % 10 == 0


def personal(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    out = []
    for rank, (kind, pattern, fits) in enumerate(kinds):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if fits(m.group())]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out))


def repeats(docs, length):
    count = Counter()
    data = [(i, (t or "").encode()) for i, t in docs]
    for _, b in data:
        count.update(b[k : k + length] for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def quality_counts(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count, cover = Counter(windows), set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            cover.update(range(k, k + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(cover))
