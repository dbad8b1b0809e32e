"""Vector codes, divergence of sources and personal data against plain versions."""

import hashlib
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from orderlens.llm import divergence, pivots, private
from orderlens.llm.common import ready
from tests.llm import plain_private
from tests.llm.brute import as_counts, lower

# --- vector codes ---


def plain_codes(rows, entries=256, rounds=4, scale=1024, parts=4):
    """rows: (id, label, vector) -> ((id, label, code, error), entries)."""
    import math
    from fractions import Fraction

    kept = [(i, lab, [math.floor(Fraction(x) * scale) for x in v]) for i, lab, v in rows]
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    order = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: (kept[k][0], kept[k][2]))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[near(c[p], books[p])[1]].append(c[p])
            for j, g in groups.items():
                books[p][j] = [sum(col) // len(g) for col in zip(*g)]
    out = []
    for (i, lab, _), c in zip(kept, cut):
        best = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, lab, "".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


VECTORS = "vec_id long, label string, embedding array<double>"


def vector_rows(rng, n, spread):
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, rng.choice("ab") if i % 7 else None, [c + rng.gauss(0, spread) for c in centres[i % 6]]) for i in range(n)]
    return rows + [rows[3], (rows[5][0], "z", rows[9][2]), (None, None, rows[1][2])]


@pytest.mark.parametrize(("entries", "spread"), [(16, 0.2), (16, 2.0), (256, 0.5)])
def test_codes_match_a_full_scan(spark, entries, spread):
    rows = vector_rows(random.Random(entries), 90, spread)
    df = ready(spark).createDataFrame(rows, VECTORS).repartition(3)
    codes, books = pivots.compress(df, entries=entries)
    want, sha = plain_codes(rows, entries)
    assert as_counts(tuple(r) for r in codes.collect()) == as_counts(want)
    assert books.sha256() == sha
    total = Counter()
    for _, label, _, error in want:
        total[label] += error
    got = pivots.with_label_errors(codes).collect()
    assert len(got) == len(rows)
    assert all(r["label_error"] == total[r["label"]] for r in got)


def test_codes_of_unsound_other_lengths_and_huge_components(spark):
    rows = vector_rows(random.Random(5), 40, 1.0)
    wide = rows + [(500, "a", [1e30] * 8), (501, "a", [-1e300] + [0.0] * 7)]
    odd = [(600, "a", None), (601, "a", [float("nan")] * 8), (602, "a", [None] * 8), (603, "a", [float("inf")] * 8), (604, "a", [1.0] * 7), (605, None, []), (606, "b", [1.0] * 4)]
    df = ready(spark).createDataFrame([(*r, 1, 2) for r in wide + odd], VECTORS + ", v int, id int").repartition(3)
    codes, books = pivots.compress(df, entries=16, id_col="vec_id")
    want, sha = plain_codes(wide, 16)
    want = [(i, lab, c, e if e < 2**63 else None) for i, lab, c, e in want]
    rest = [(604, "a", None, None), (605, None, None, None), (606, "b", None, None)]
    assert as_counts(tuple(r) for r in codes.collect()) == as_counts(want + rest)
    assert books.sha256() == sha
    pivots.with_label_errors(codes).collect()


def test_codes_of_empty_tables(spark):
    for rows in ([], [(None, None, [1.0] * 8)], [(1, "a", None)]):
        codes, books = pivots.compress(ready(spark).createDataFrame(rows, VECTORS))
        assert pivots.with_label_errors(codes).count() == (1 if rows and rows[0][2] else 0)
        assert books.sha256() == hashlib.sha256(b"").hexdigest()


def test_bounds_prune_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(1)
    entries = rng.integers(-2000, 2000, (256, 4))
    entries[200] = entries[7]
    x = entries[rng.integers(0, 256, 400)] + rng.integers(-20, 20, (400, 4))
    at = pivots.pick_pivots(entries, 8)
    to = pivots._roots(pivots.squares(x[:, None, :], at[None]))
    index, d, evaluated = pivots.nearest(x, to, entries, at)
    full = pivots.squares(x[:, None, :], entries[None])
    assert (d == full.min(axis=1)).all() and (index == full.argmin(axis=1)).all()
    assert evaluated < 0.2 * full.size


# --- divergence ---


def plain_audit(docs, min_docs, top):
    """docs: (lang, source, text)."""
    words = [(a or "", b or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))) for a, b, t in docs]
    out = []
    for lang in {a for a, _, _ in words}:
        seen, counts = Counter(), defaultdict(Counter)
        for a, b, w in words:
            if a == lang:
                seen.update(set(w))
                counts[b].update(w)
        kept = [t for t, n in seen.items() if n >= min_docs]
        whole = sum(counts.values(), Counter())

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // n for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in counts if o != s)
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, i.decode(), -v, r + 1) for part, rows in (("pair", pairs), ("term", terms)) for r, (v, i) in enumerate(rows)]
    return out


DOCS = "lang string, source string, text string"


def audit_docs(rng):
    vocabulary = [f"w{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(60)]
    docs = []
    for i in range(160):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(6)}"
        docs.append((rng.choice(["en", "en", "de"]), source, " 1, ".join(rng.choice(vocabulary[: 20 + 8 * (i % 5)]).title() for _ in range(rng.randrange(30)))))
    docs += [("en", "empty", None), ("en", None, ""), (None, None, "lone words"), (None, "x", "lone"), ("fr", "a", "!!"), ("fr", "b", None), docs[0], docs[0]]
    docs.append(("de", "long", "long " * 400_000 + "É" * 2_000_000))
    return docs


@pytest.mark.parametrize("parts", [5, 150])  # 150 tasks: runs are merged in two steps
def test_divergence_matches_plain_version(spark, monkeypatch, parts):
    if parts > 5:
        monkeypatch.setattr(divergence, "SHARDS", 4)
    docs = audit_docs(random.Random(8))
    table = ready(spark).createDataFrame([(*d, 1, "x") for d in docs], DOCS + ", shard int, term string").repartition(parts)
    got = divergence.audit(table, min_docs=6, top=7)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert as_counts(tuple(r) for r in got.collect()) == as_counts(plain_audit(docs, 6, 7))


def test_corrections_in_source_blocks_and_small_batches():
    """Blocks of sources and batches of terms give the sums that one matrix gives."""
    import pyarrow as pa

    rng = random.Random(3)
    sources = [f"s{i}" for i in range(7)]
    rows = [(f"t{i:02}", *zip(*[(s, rng.randrange(1, 50)) for s in sources if rng.random() < 0.5] or [("s0", 1)])) for i in range(40)]
    n = {s: sum(c for _, held, counts in rows for x, c in zip(held, counts) if x == s) for s in sources}
    right = pa.table({"source": sources, "n": [n[s] for s in sources]})

    def parts(blocks):
        out = Counter()
        for block in range(blocks):
            left = pa.table({"lang": ["en"] * 40, "block": [block] * 40, "blocks": [blocks] * 40, "kept_terms": [40] * 40, "term": [r[0] for r in rows], "sources": [list(r[1]) for r in rows], "counts": [list(r[2]) for r in rows]})
            out.update(tuple(r.values()) for r in divergence._correct(3)(("en", 0, block), left, right).to_pylist())
        return out

    assert parts(1) == parts(3) and len(parts(1)) > 40


def test_divergence_of_empty_and_single_tables(spark):
    assert divergence.audit(ready(spark).createDataFrame([], DOCS)).count() == 0
    assert divergence.audit(ready(spark).createDataFrame([("en", "a", None)], DOCS)).count() == 0


def test_blocks_spill_sorted_runs_that_merge_to_the_counts():
    rng = random.Random(2)
    texts = [("en", f"s{rng.randrange(3)}", " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(30)).encode()) for _ in range(40)]
    runs = []
    for i in range(0, 40, 7):
        block = divergence.Block()
        block.add(texts[i : i + 4])
        block.add(texts[i + 4 : i + 7])
        run = block.run()
        assert run.keys == sorted(run.keys)
        runs.append([divergence.Run.read(p) for _, p in run.split(3)])
    want, seen = defaultdict(Counter), Counter()
    for _, source, raw in texts:
        want["en\0"][source] += 0
        for w in raw.decode().split():
            want["en\0" + w][source] += 1
        seen.update({"en\0" + w for w in raw.decode().split()})
    got = {}
    for shard in range(3):
        merged = divergence.merge_runs([parts[shard] for parts in runs], 2)
        assert merged.keys == sorted(merged.keys)
        for k, d, a, b in zip(merged.keys, merged.docs, merged.starts, merged.starts[1:]):
            got[k.decode()] = (int(d), {merged.sources[c]: int(n) for c, n in zip(merged.codes[a:b], merged.counts[a:b])})
    assert got == {k: (seen[k], dict(c)) for k, c in want.items() if seen[k] >= 2 or k == "en\0"}


def test_shares_are_exact_for_large_counts():
    rng = random.Random(4)
    for _ in range(500):
        total = rng.randrange(1, 9 * 10**15)
        count = rng.randrange(0, total + 1)
        assert int(divergence.share(np.array([count]), np.array([total]))[0]) == 1 + 10**9 * count // total


# --- personal data ---

PLACES = ["call us at {} today", "Tel.: {}", "write to {} for help", "mail: {}", "host {} is down", "paid with card {} on", "see {} there", "in the year {} was"]


def some_value(rng, kind):
    digits = "".join(rng.choice("0123456789") for _ in range(12))
    if kind == "phone":
        return f"+{rng.randrange(1, 99)} ({digits[:3]}) {digits[3:6]}-{digits[6:10]}"
    if kind == "email":
        return f"u{digits[:4]}@mail{digits[5]}.example.com"
    if kind == "ip":
        return ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == "card":
        head = "4" + digits + "00"
        return next(head + c for c in "0123456789" if plain_private.luhn(head + c))
    if kind == "local":
        return f"0{digits[:3]}/{digits[4:11]}"
    if kind == "masked":
        return f"u{digits[:4]}(at)example"
    return digits[: rng.randrange(1, 9)]


def private_docs(rng):
    kinds = {0: ["phone", "phone", "local"], 1: ["phone", "phone", "phone", "local"], 2: ["email", "email", "masked"], 3: ["email", "email", "masked"], 4: ["ip"], 5: ["card", "card", "number"]}
    docs = []
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(4)):
            place = rng.randrange(len(PLACES))
            parts.append(PLACES[place].format(some_value(rng, rng.choice(kinds.get(place, ["phone", "email", "ip", "card", "number", "local"])))) + rng.choice([". ", "\n", " ## ", " É "]))
        docs.append((i, "".join(parts)))
    docs += [(None, "Tel.: 030/1234567"), (200, None), (201, ""), (7, docs[7][1]), (7, docs[7][1])]
    docs += [(300, "a@b.c_d@e.f x@y 1.2.3.4.5.6.7.8 256.1.1.1 00255.0.0.1 +1 ((( +12345678 4111 1111 1111 1111 4111111111111112 4111-1111-1111-1111-0000")]
    docs += [(301, "@" * 500), (302, "a" * 300 + "@x.yz"), (303, "1" * 300), (304, "1.1." * 300), (305, "a@" + "b." * 400 + "c"), (306, "+1" + " " * 2000)]
    docs += [(307, "mail me@x.org 12 " * 1_500)]  # more matches than one chunk of offsets
    return docs


def test_private_matches_plain_version(spark):
    docs = private_docs(random.Random(6))
    df = ready(spark).createDataFrame([(*d, "x", 1, "y") for d in docs], "doc_id long, text string, email string, rid int, base string").repartition(4)
    got = as_counts(tuple(r) for r in private.find_private(df).collect())
    want = as_counts(plain_private.find(docs))
    assert got == want
    assert sum(r[-1] for r in want) > 20


def test_private_contexts_find_other_forms_and_leave_plain_numbers(spark):
    rng = random.Random(1)
    docs = [(i, f"{['Send', 'Please'][i % 2]} it. Telefon: {some_value(rng, 'phone')} Ende") for i in range(12)]
    docs += [(100, "Anruf. Telefon: 030/9876543 Ende"), (101, "Artikel 1234567 im Lager"), (102, "Version 2.0.1 of 2024-01-31")]
    docs += [(103, "again " + re.sub(r"[^0-9]", "", docs[0][1]) + " without its form")]
    got = {r["doc_id"]: r for r in private.find_private(ready(spark).createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[100]["spans"] == "phone:16:27" and got[100]["n_phone"] == 0
    assert got[101]["spans"] == "" and got[102]["spans"] == ""
    assert got[103]["n_found"] == 1
    assert all(got[i]["n_phone"] == 1 and got[i]["n_found"] == 0 for i in range(12))


def test_private_long_texts_take_linear_time(spark):
    docs = [(301, "@" * 500_000), (302, "a" * 1_000_000 + "@x.yz"), (303, "1" * 1_000_000), (304, "1.1." * 100_000), (305, "a@" + "b." * 400_000 + "c"), (306, "+1" + " " * 1_000_000), (307, "me@x.org 12 " * 20_000)]
    start = time.time()
    got = {r["doc_id"]: r for r in private.find_private(ready(spark).createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()}
    assert time.time() - start < 60
    assert [got[i]["n_email"] for i in (301, 302, 303, 305, 307)] == [0, 1, 0, 1, 20_000]
    assert got[304]["n_ip"] == 50_000 and got[302]["spans"] == "email:0:1000005"
    assert got[307]["spans"].endswith(f"email:{12 * 19_999}:{12 * 19_999 + 8}")


def test_private_plan_has_no_python(spark, capsys):
    df = ready(spark).range(1).selectExpr("id as doc_id", "'x@y.zz' as text")
    private.scan(df).explain("formatted")
    private.find_private(df).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_private_empty_table(spark):
    assert private.find_private(ready(spark).createDataFrame([], "doc_id long, text string")).count() == 0
