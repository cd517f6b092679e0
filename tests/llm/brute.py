"""Plain Python versions of the operators' rules, for small inputs."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_failed(text):
    w = words(text)
    wins = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    seen = Counter(wins)
    hit = {j for i, x in enumerate(wins) if seen[x] > 1 for j in range(i, i + 8)}
    return len(w) < 20 or 100 * len(hit) > 30 * len(w)


def shingles(text, n):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def components(rows, n):
    """{doc_id: smallest reachable} of (doc_id, text) rows."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    label = {i: i for i, _ in sets}
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1:] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def one_of_each(rows, n):
    """(id, text) of the document that stays of each group; a document is an id with a text."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is None, d[0] or 0, d[1]))
    label = components([(k, t) for k, (_, t) in enumerate(docs)], n)
    return [d for k, d in enumerate(docs) if label[k] == k]


def kept_words(texts, width=35):
    """What is left of each text, as a list of words."""
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + width]) for w in all_words for i in range(len(w) - width + 1))
    out = []
    for w in all_words:
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for j in range(i, i + width)}
        out.append([x for j, x in enumerate(w) if j not in gone])
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
