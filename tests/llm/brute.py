"""Plain versions of the operators for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WS = " \t\n\x0b\x0c\r"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def kept_lines(docs, min_docs, keep_first=False):
    """docs: (id, text) rows -> (id, lines, dropped, kept text)."""
    where = defaultdict(list)
    for row, (_, text) in enumerate(docs):
        for key in {lower(x).strip(WS) for x in (text or "").split("\n")}:
            where[key].append(row)
    gone = {k: min((docs[r][0] for r in rows if docs[r][0] is not None), default=None) for k, rows in where.items() if k and len(rows) >= min_docs}
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        keep = [x for x in lines if (k := lower(x).strip(WS)) not in gone or (keep_first and doc is not None and gone[k] == doc)]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def shingle_set(text, k):
    words = [w for w in re.split("[\x20\x09-\x0d]+", lower(text)) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def near_groups(docs, k, percent):
    """(id, set size, smallest id reachable) for each row."""
    sets = [shingle_set(t, k) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return [(doc, len(sets[i]), low.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def phrase_hits(docs, items, width):
    """(id, words, hit words, item ids as sorted strings) for each row."""
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall(lower(text))
        for i in range(max(1, len(words) - width + 1) if words and item is not None else 0):
            windows[tuple(words[i : i + width])].add(str(item))
    out = []
    for doc, text in docs:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for window, ids in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        out.append((doc, len(words), len(hit), sorted(found)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def as_counts(rows):
    return Counter(map(tuple, rows))
