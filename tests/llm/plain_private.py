"""Plain version of the search for personal data."""

import hashlib
import re
from collections import defaultdict

KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
FORM = {"email": "address", "ip": "host", "card": "number", "phone": "number"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text):
    return [(i, m.start(), m.end()) for i, k in enumerate(KINDS) for m in re.finditer(BASE[k], text) if good(k, m.group())]


def contexts(text, pieces_before, pieces_after):
    def words(side):
        return re.sub("[0-9]", "9", side.lower()).split()

    left, right = words(pieces_before[-80:]), words(pieces_after[:80])
    if not left:
        return []
    out = ["l " + left[-1]]
    if len(left) > 1:
        out.append("ll " + " ".join(left[-2:]))
    if right:
        out.append(f"lr {left[-1]} _ {right[0]}")
    return out


def between(text, pattern):
    found = list(re.finditer(pattern, text, re.A))
    ends = [0, *[m.end() for m in found]]
    starts = [*[m.start() for m in found], len(text)]
    return [(m, text[ends[i] : m.start()], text[m.end() : starts[i + 1]]) for i, m in enumerate(found)]


def form_of(value):
    digits = re.sub("[^0-9]", "", value)
    if re.search(r"\A\S+(?:@|\((?i:at)\)|\[(?i:at)\])\S+\Z", value, re.A):
        return "address"
    if re.search(r"\A[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}\Z", value):
        return "host"
    if re.search(r"\A[+(]?[0-9][0-9().\x20/-]*\Z", value) and not re.search(r"\A[0-9]{1,4}(?:[./-][0-9]{1,4}){1,2}\Z", value) and 6 <= len(digits) <= 19:
        return "number"
    return "other"


def key_of(form, value):
    return form, re.sub("[^0-9]", "", value) if form == "number" else value.lower()


def instances(text):
    base = base_spans(text)
    out = []
    for i, k in enumerate(KINDS):
        for m, before, after in between(text, BASE[k]):
            if good(k, m.group()):
                out.append((i, m.start(), m.end(), key_of(FORM[k], m.group()), contexts(text, before, after)))
    for m, before, after in between(text, r"(?<!\S)(?=\S*?(?:[0-9@]|\(at\)|\[at\]))\S+(?:\x20\(?[0-9]\S*)*"):
        head = re.sub(r"\A[^0-9A-Za-z+(@]+", "", m.group())
        value = re.sub(r"[^0-9A-Za-z)]+\Z", "", head)
        start = m.start() + len(m.group()) - len(head)
        if value and not any(a < start + len(value) and start < b for _, a, b in base):
            out.append((-1, start, start + len(value), key_of(form_of(value), value), contexts(text, before, after)))
    return out


def find(docs, rounds=3, min_support=4, min_confidence=0.8, min_score=0.8, doubt=0.25):
    every = [instances(t or "") for _, t in docs]
    score = defaultdict(lambda: [0.0] * 4)
    seeds, edges = set(), defaultdict(set)
    for found in every:
        for kind, _, _, key, cs in found:
            score[key]
            if kind >= 0:
                score[key][kind] = 1.0
                seeds.add(key)
            for c in cs:
                edges[c].add(key)
    for _ in range(rounds):
        sure = {}
        for c, keys in edges.items():
            for i, k in enumerate(KINDS):
                open_ = sum(max(score[x]) == 0 and x[0] == FORM[k] for x in keys)
                value = sum(score[x][i] for x in keys) / (len(keys) - open_ * (1 - doubt) + 1)
                if sum(score[x][i] > 0 for x in keys) >= min_support and value >= min_confidence:
                    sure[c, i] = value
        left = defaultdict(lambda: [1.0] * 4)
        for (c, i), value in sure.items():
            for x in edges[c]:
                left[x][i] *= 1 - value
        for x in score:
            if x not in seeds:
                score[x] = [round(1 - left[x][i], 9) if x[0] == FORM[k] else 0.0 for i, k in enumerate(KINDS)]
    out = []
    for (doc, text), found in zip(docs, every):
        base = base_spans(text or "")
        more = [(score[key].index(max(score[key])), a, b) for kind, a, b, key, _ in found if kind < 0 and key[0] != "other" and max(score[key]) >= min_score]

        def say(spans):
            return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)

        out.append((doc, *[sum(k == i for k, _, _ in base) for i in range(4)], hashlib.sha256(say(base).encode()).hexdigest(), say(sorted(base + more)), len(more)))
    return out
