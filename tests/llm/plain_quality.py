"""Plain version of importance resampling: dictionaries and loops over the grams of each text."""

import math
from collections import Counter

from orderlens.llm import quality as q


def flags_of(labels):
    """doc_id -> (worst quality, worst toxicity) of its labels; None where no label says it."""
    seen = {}
    for doc, good, toxic in labels:
        if doc is not None:
            g, t = seen.get(doc, (None, None))
            seen[doc] = (good if g is None else g if good is None else min(g, good), toxic if t is None else t if toxic is None else max(t, toxic))
    return {d: f for d, f in seen.items() if f != (None, None)}


def cut_of(values, good):
    """Every place between sorted values, and both ends: where bad below plus good above is largest."""
    if not any(good) or all(good):
        return -math.inf
    rows = sorted(zip(values, good))
    best, place = -1.0, 0
    for at in range(len(rows) + 1):
        if 0 < at < len(rows) and rows[at][0] == rows[at - 1][0]:
            continue
        score = sum(not g for _, g in rows[:at]) / good.count(False) + sum(g for _, g in rows[at:]) / good.count(True)
        if score > best + 1e-12:
            best, place = score, at
    return (rows[max(0, place - 1)][0] + rows[min(len(rows) - 1, place)][0]) / 2


def resample(docs, labels, uniform):
    """docs: (id, text); uniform: a number in (0, 1) for each id -> (id, words, weight, draw or None, kept) for each row."""
    flags = flags_of(labels)
    words = [q._words((t or "").encode()) for _, t in docs]
    found = [q.grams(v).tolist() for v in words]
    raw, target = Counter(), Counter()
    for (doc, _), grams in zip(docs, found):
        raw.update(grams)
        good, toxic = flags.get(doc, (None, None))
        if good == 1 and not toxic:
            target.update(grams)

    def total(counts, words_too):
        return sum(n for b, n in counts.items() if (b >= q.BUCKETS) == words_too)

    def ratio(b):
        if b < q.BUCKETS:
            if not total(target, False):
                return 0.0
            p = (raw[b] + 1) / (total(raw, False) + q.BUCKETS)
            return math.log((1 - q.SMOOTH) * target[b] / total(target, False) + q.SMOOTH * p) - math.log(p)
        if not total(target, True):
            return 0.0
        return math.log((target[b] + q.WORD_SHRINK) / (raw[b] * total(target, True) / total(raw, True) + q.WORD_SHRINK))

    ratios = {b: ratio(b) for b in raw}
    weights = [q.TEMPER * sum(ratios[b] for b in grams) / (len(v) + q.SHRINK) for grams, v in zip(found, words)]

    toxic_texts = {}
    for doc, text in docs:
        toxic = flags.get(doc, (None, None))[1]
        if toxic is not None:
            toxic_texts[text or ""] = max(toxic_texts.get(text or "", 0), toxic)
    n = Counter(t > 0 for t in toxic_texts.values())
    held = {True: Counter(), False: Counter()}
    for text, toxic in toxic_texts.items():
        held[toxic > 0].update(set(q.word_grams(q._words(text.encode())).tolist()))
    model = {}
    tried = [g for g in held[True].keys() | held[False].keys() if held[True][g] + held[False][g] >= q.TOXIC_LEAST]
    for g in tried if len(n) == 2 else ():
        a, b = held[True][g], held[False][g]
        like, share = b * n[True] / n[False], n[True] / (n[True] + n[False])
        if a > like:
            g2 = 2 * (a * math.log(a / ((a + b) * share)) + (b * math.log(b / ((a + b) * (1 - share))) if b else 0))
            if g2 >= 2 * math.log(max(2, len(tried))):
                model[g] = math.log((a + q.TOXIC_SHRINK) / (like + q.TOXIC_SHRINK))
    bad = [sum(model[g] for g in set(q.word_grams(v).tolist()) if g in model) for v in words]

    known = [(i, *flags[doc]) for i, (doc, _) in enumerate(docs) if doc in flags]
    worst = cut_of([bad[i] for i, _, t in known if t is not None], [t > 0 for _, _, t in known if t is not None])
    judged = [(i, g) for i, g, t in known if not t and g is not None]
    cut = cut_of([weights[i] for i, _ in judged], [g == 1 for _, g in judged])
    sound = [worst == -math.inf or not model or b < worst for b in bad]
    draws = [w - math.log(-math.log(uniform[doc])) if ok else None for (doc, _), w, ok in zip(docs, weights, sound)]
    k = sum(ok and w >= cut for ok, w in zip(sound, weights))
    bar = sorted((d for d in draws if d is not None), reverse=True)[k - 1] if k else math.inf
    return [(doc, len(v), w, d, d is not None and d >= bar) for (doc, _), v, w, d in zip(docs, words, weights, draws)]
