"""Lines, phrases, near-duplicates, packing, quality and secrets against plain versions."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from orderlens.llm import decontam, lines, neardup, packing, quality, secrets
from orderlens.llm.common import ready
from orderlens.llm.queries import tokenizer_path
from tests.llm import brute

DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def rng():
    return random.Random(3)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows, schema=DOCS, parts=3):
    return ready(spark).createDataFrame(rows, schema).repartition(parts) if rows else ready(spark).createDataFrame([], schema)


# --- lines ---


def line_docs(rng):
    common = [f" Shared line {i} É\t" for i in range(6)]
    docs = [(i, "\n".join(rng.sample(common, 3) + [words(rng, 4)] + [""])) for i in range(30)]
    docs += [(i, "same\nsame") for i in range(100, 112)]  # copies: repeated lines in one document count once
    docs += [(None, "Same\nother"), (None, common[0]), (7, docs[7][1]), (200, None), (201, ""), (202, "\n\n"), (203, "x" * 200_000 + "\nSAME")]
    return docs


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_lines_match_plain_version_with_and_without_broadcast(spark, rng, keep_first, limit):
    docs = line_docs(rng)
    got = lines.drop_repeated_lines(frame(spark, docs), min_docs=10, keep_first=keep_first, broadcast_bytes=limit, bucket_bytes=50_000)
    assert brute.as_counts(tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "kept").collect()) == brute.as_counts(brute.kept_lines(docs, 10, keep_first))


def test_lines_clashing_columns_and_empty_table(spark):
    rows = [(1, "a\nb", "x", 5, 6)] * 10
    schema = "doc_id long, text string, bucket string, n_lines int, text_utf8 int"
    for limit in (32 << 20, 0):
        got = lines.drop_repeated_lines(frame(spark, rows, schema), min_docs=10, broadcast_bytes=limit)
        assert got.columns == ["doc_id", "bucket", "text_utf8", "n_lines", "n_dropped", "kept"]
        assert [tuple(r) for r in got.collect()] == [(1, "x", 6, 2, 2, "")] * 10
        assert lines.drop_repeated_lines(frame(spark, []), broadcast_bytes=limit).count() == 0


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.random.default_rng(1).integers(0, 2**63, 30_000, dtype=np.uint64)
    keys = np.unique(keys)
    ph = lines.PerfectHash.build(keys)
    assert sorted(ph.place(keys).tolist()) == list(range(len(keys)))
    assert ph.place(np.zeros(0, np.uint64)).tolist() == []
    assert lines.PerfectHash.build(np.zeros(0, np.uint64)).place(keys[:5]).tolist() == [-1] * 5


# --- phrases ---


def phrase_tables(rng):
    items = [(i, words(rng, rng.choice([3, 9, 10, 11, 30]), 60)) for i in range(12)]
    items += [(50, "Ünique, words!"), (51, ""), (52, None), (None, "w1 w2"), (53, "w3"), (0, items[0][1]), (60, words(rng, 2500, 3000))]
    docs = []
    for i in range(40):
        item = rng.choice(items)[1] or ""
        docs.append((i, f"{words(rng, rng.randrange(30), 60)} {item.upper() if i % 2 else item}; {words(rng, 20, 60)}"))
    docs += [(None, items[3][1]), (5, docs[5][1]), (5, docs[5][1]), (90, None), (91, ""), (92, "?!"), (93, " ".join([items[1][1]] * 300)), (94, "ünique words w3")]
    return docs, items


def test_contamination_holds_one_block_of_windows(spark, rng, monkeypatch):
    import gc
    import weakref

    class Windows(dict):
        pass

    alive, made = [], decontam.windows_of

    def watched(*args):
        gc.collect()
        assert not [r for r in alive if r() is not None]
        terms, windows = made(*args)
        windows = Windows(windows)
        alive.append(weakref.ref(windows))
        return terms, windows

    monkeypatch.setattr(decontam, "windows_of", watched)
    items = [(i, words(rng, 30)) for i in range(20)]
    docs = [(i, f"{words(rng, 20)} {items[i % 20][1]} end") for i in range(30)]
    found = decontam.contamination(frame(spark, docs), frame(spark, items, "item_id long, text string"), width=10, block_words=130)
    assert {r["n_hit"] for r in found.collect()} == {30}
    assert len(alive) >= 4


@pytest.mark.parametrize("block_words", [500_000, 300])
def test_phrases_match_plain_version_in_one_and_many_blocks(spark, rng, block_words):
    docs, items = phrase_tables(rng)
    got = decontam.contamination(frame(spark, docs), frame(spark, items, "item_id long, text string"), width=10, block_words=block_words)
    rows = got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items").collect()
    expected = brute.phrase_hits(docs, items, 10)
    assert brute.as_counts((r.doc_id, r.n_words, r.n_hit, ",".join(r["items"])) for r in rows) == brute.as_counts((d, n, h, ",".join(i)) for d, n, h, i in expected)
    assert all(r.items_sha256 == brute.sha(",".join(r["items"])) and r.n_items == len(r["items"]) and r.contaminated == (r.n_hit > 0) for r in rows)


def test_phrases_without_documents_or_items(spark):
    docs, items = frame(spark, [(2**60 + 1, "a b")]), frame(spark, [], "item_id long, text string")
    got = decontam.contamination(docs, items)
    assert [(r.doc_id, r.n_words, r.n_hit) for r in got.collect()] == [(2**60 + 1, 2, 0)]
    assert decontam.contamination(frame(spark, []), items).count() == 0


def test_proximity_finds_terms_in_any_order(spark):
    items = frame(spark, [(1, "red green blue")], "item_id long, text string")
    docs = frame(spark, [(1, "blue and red and green"), (2, "red x x x x x x x x green blue"), (3, "red green")])
    got = decontam.contamination(docs, items, width=3, within=4)
    assert {r.doc_id: r.contaminated for r in got.collect()} == {1: True, 2: False, 3: False}


# --- near-duplicates ---


def near_docs(rng):
    docs, base = [], [words(rng, 60, 5000) for _ in range(5)]
    for i in range(120):  # chains of edits, so that components are longer than links
        text = base[i % 5].split()
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = f"new{rng.randrange(9)}"
        docs.append((i + 3, " ".join(text)))
        if i % 7 == 0:
            base[i % 5] = " ".join(text)
    docs += [(1000 + i, docs[4][1]) for i in range(20)] + [(docs[9][0], docs[9][1]), (None, docs[8][1]), (None, "lone null text here"), (None, "lone null text here")]
    docs += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one two"), (2004, "ONE\ttwo"), (2005, "two one"), (2006, words(rng, 50_000, 100))]
    return docs


def test_near_duplicates_match_all_pairs(spark, rng):
    docs = near_docs(rng)
    got = neardup.near_duplicates(frame(spark, docs), k=3, percent=85).collect()
    expected = brute.near_groups(docs, 3, 85)
    assert brute.as_counts((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute.as_counts(expected)
    assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
    groups = {}
    for r in got:
        if r.n_shingles and r.component_id is not None:
            groups.setdefault(r.component_id, []).append(r.first_row)
    assert all(sum(g) == 1 for g in groups.values())


def test_members_that_no_star_joins_are_compared(spark, monkeypatch):
    """With one-row bands, buckets mix groups; only the comparison in blocks can join what the pivot is unlike."""
    monkeypatch.setattr(neardup, "band_rows", lambda percent, samples=128: 1)
    monkeypatch.setattr(neardup, "BLOCK", 3)
    rng = random.Random(5)
    shared, docs = words(rng, 30, 5000), []
    for g in range(8):
        text = f"{shared} {words(rng, 40, 5000)}"
        docs += [(10 * g + j, text + " tail" * j) for j in range(3)]
    got = neardup.near_duplicates(frame(spark, docs), k=3, percent=80).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(d, c) for d, _, c in brute.near_groups(docs, 3, 80)}


def test_components_of_a_long_chain(spark):
    rng = random.Random(1)
    order = list(range(300))
    rng.shuffle(order)
    links = frame(spark, list(zip(order, order[1:], strict=False)) + [(1000, 1001)], "a long, b long")
    got = {r.node: r.comp for r in neardup.components(links).collect()}
    assert got == {**{i: 0 for i in order if i}, 1001: 1000}


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(frame(spark, [])).count() == 0
    assert [tuple(r)[1:] for r in neardup.near_duplicates(frame(spark, [(1, None)])).drop("text_hash").collect()] == [(1, 0, 1, True, True)]


@pytest.mark.parametrize("size", [20, 170, 1000, 20_000])
def test_sketches_let_threshold_pairs_pass_and_stop_unlike_ones(size):
    rng = np.random.default_rng(2)

    def differing(shared):
        sets = []
        for _ in range(60):
            values = rng.integers(0, 2**63, 2 * size - shared, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            sets += [np.sort(values[:size]), np.sort(np.concatenate([values[:shared], values[size:]]))]
        sketch = neardup.odd_sketch(sets)
        return np.bitwise_count(sketch[::2] ^ sketch[1::2]).sum(axis=1)

    most = neardup._most(np.array([float(size)]), size, 80)[0]
    assert differing(int(np.ceil(size * 160 / 180))).max() <= most  # a similarity of 0.8
    assert differing(int(size * 0.7)).min() > most  # of 0.54


# --- packing ---


def packed(spark, docs, **params):
    got = packing.pack(frame(spark, docs), tokenizer_path(), **params).collect()
    for sequence in {r.sequence_id for r in got}:
        at = 0
        for r in sorted((r for r in got if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= params.get("seq_len", 2048)
    return got


def test_packing_gives_back_every_id_once(spark, rng):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    docs = [(i, words(rng, rng.randrange(1, 900)) + ", é Don't  <|endoftext|>!") for i in range(60)] + [(100, None), (101, ""), (102, words(rng, 3000)), (None, "null id"), (103, "ÀB\tc\n\nd")]
    got = packed(spark, docs)
    for doc, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in pieces)


def test_packing_cuts_long_remainders_where_nothing_fits(spark):
    docs = [(i, "a " * 1199) for i in range(40)]  # 1,200 ids each: no two share a sequence whole
    got = packed(spark, docs)
    assert len({r.sequence_id for r in got}) <= 26 and sum(r.length for r in got) == 48_000
    assert packed(spark, []) == []


def test_patterns_take_every_piece_and_come_near_the_bound():
    rng = np.random.default_rng(4)
    counts = {int(s): int(n) for s, n in zip(rng.permutation(np.arange(1, 200))[:60], rng.integers(1, 500, 60), strict=True)}
    patterns, optimum = packing.plan_patterns(counts, 256)
    used = {}
    for pattern, times in patterns:
        assert sum(s * n for s, n in pattern.items()) <= 256
        for s, n in pattern.items():
            used[s] = used.get(s, 0) + n * times
    assert used == counts
    assert sum(n for _, n in patterns) <= optimum * 1.01 + 30


# --- quality ---


def test_quality_parts_held_out_rows_and_keeps_good_ones(spark, rng):
    def good():
        return " ".join(w + ("." if rng.random() < 0.1 else "") for w in words(rng, 80, 3000).split())

    def bad():
        return rng.choice([lambda: (words(rng, 40).upper().replace(" ", "!! ")), lambda: " ".join(f"{w} {w} {w}" for w in words(rng, 20).split()), lambda: words(rng, 40).replace(" ", " | ")])()

    docs = [(i, bad() if i % 5 == 0 else good()) for i in range(600)] + [(1000, None), (1001, ""), (None, good())]
    labels = frame(spark, [(i, int(i % 5 != 0), 0) for i in range(0, 300)] + [(None, 1, 0), (5000, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.resample(frame(spark, docs), labels, max_labelled=200).collect()}
    assert len(got) == 603
    assert all(got[i].kept == (i % 5 != 0) for i in range(600)) and got[None].kept
    assert got[1000].n_grams == 0 and got[1000].log_weight == 0.0


def test_quality_rejects_toxic_documents_and_keeps_clean_ones_beside_them(spark, rng):
    insults = ["oafish", "wretch", "numbskull", "vermin"]

    def text(i):
        given = words(rng, 2000 if i % 3 == 0 else 80, 3000).split()
        if i % 5 == 0:  # a passage, also in long documents
            for w in rng.sample(insults, 2):
                given.insert(rng.randrange(len(given)), rng.choice([w, w.capitalize() + ",", w + "."]))
        return " ".join(given)

    docs = [(i, f"{words(rng, 20)} | ".replace(" ", " | ") if i % 7 == 1 and i % 5 else text(i)) for i in range(600)] + [(1000, None)]
    labels = frame(spark, [(i, int(not (i % 7 == 1 and i % 5)), int(i % 5 == 0)) for i in range(0, 300)] + [(1000, 1, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.resample(frame(spark, docs), labels).collect()}
    assert len(got) == 601
    assert not [i for i in range(0, 600, 5) if got[i].kept]
    clean = [i for i in range(600) if i % 5 and i % 7 != 1]
    assert all(got[i].draw is not None for i in clean) and sum(got[i].kept for i in clean) >= 0.98 * len(clean)
    assert not any(got[i].kept for i in range(600) if i % 7 == 1 and i % 5)


def test_quality_matches_plain_version(spark, rng):
    from pyspark.sql import functions as F

    from tests.llm import plain_quality

    docs = []
    for i in range(160):
        text = words(rng, rng.randrange(5, 60), 80)
        if i % 4 == 1:
            text = " ".join(f"{w.upper()}$$ {rng.randrange(99)}" for w in text.split())
        if i % 6 == 2:
            text += " " + " ".join(rng.choice(["vile", "slur", "hate"]) for _ in range(4))
        docs.append((i, text))
    docs += [(500, None), (501, ""), (502, docs[3][1]), (503, docs[3][1]), (504, "É ö 12 .;")]  # ties in the weight
    labels = [(i, int(i % 4 != 1), int(i % 6 == 2)) for i in range(0, 120)] + [(3, 0, None), (500, 1, None), (501, None, 0), (502, None, None), (None, 1, 0)]
    df = frame(spark, docs)
    hashed = df.select("doc_id", ((F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 52)) + 0.5) / float(1 << 52)).alias("u")).collect()
    want = {r[0]: r for r in plain_quality.resample(docs, labels, {r["doc_id"]: r["u"] for r in hashed})}
    got = quality.resample(df, frame(spark, labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(docs) and 0 < sum(r["kept"] for r in got) < len(docs)
    for r in got:
        _, n, weight, draw, kept = want[r["doc_id"]]
        assert (r["n_grams"], r["kept"]) == (n, kept)
        assert r["log_weight"] == pytest.approx(weight, rel=1e-9, abs=1e-9)
        assert r["draw"] == (draw if draw is None else pytest.approx(draw, rel=1e-9, abs=1e-9))


def test_quality_without_labels_keeps_all(spark):
    none = frame(spark, [], "doc_id long, quality int, toxic int")
    docs = frame(spark, [(1, "a", 5), (1, "a", 6), (2, None, 7)], "doc_id long, text string, kept int")
    got = quality.resample(docs, none)
    assert got.columns == ["doc_id", "text", "n_grams", "log_weight", "draw", "kept"] and [r.kept for r in got.collect()] == [True] * 3
    assert quality.resample(frame(spark, []), none).count() == 0


def test_kth_largest_by_counting(spark):
    values = [random.Random(2).gauss(0, 50) for _ in range(3000)] + [7.0] * 500
    df = frame(spark, [(v,) for v in values], "v double")
    ordered = sorted(values, reverse=True)
    assert all(quality.kth_largest(df, "v", k, few=10, bins=8) == ordered[k - 1] for k in (1, 2, 1500, 3500))


# --- secrets ---


def plain_base(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def test_secrets_match_plain_patterns(spark, rng):
    bits = ["Password", "='", "token : ", "secret=", "API_KEY=", "apikey:", "aſſwd", "AKIA", "0123456789abcdef", "ABCDEFGHIJKLMNOPQ", "é", " ", "\n", "x.y-z", "AKIAAKIA", "toKen", "deadbeef" * 3, "password=token=abcdefghijklm", "secret: token: abcdefghijklmnop"]
    docs = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(400)] + [(900, None), (901, "é" * 100_000 + "AKIA" + "A1" * 10), (1, "AKIA" + "B" * 20)]
    got = secrets.find_secrets(frame(spark, docs)).collect()
    expected = [(d, brute.sha(plain_base(t))) for d, t in docs]
    assert brute.as_counts((r.doc_id, r.base_sha256) for r in got) == brute.as_counts(expected)
    assert secrets.find_secrets(frame(spark, [])).count() == 0


def test_entropy_finds_random_strings_and_spares_allowed_ones(spark):
    key = "kQ9zT3xWv7Lm2RbY5sJd8HfN1pGc4"
    rows = [(1, f"use {key} now"), (2, "123e4567-e89b-42d3-a456-426614174000"), (3, "internationalisation_of_words_2024"), (4, f"http://{key}"), (5, "EXAMPLE" + key), (6, "2024-0101-0000-0000-0000_000")]
    got = {r.doc_id: r.spans for r in secrets.find_secrets(frame(spark, rows)).collect()}
    assert got == {1: f"entropy:4:{4 + len(key)}", 2: "", 3: "", 4: "", 5: "", 6: ""}


def test_entropy_scans_passwords_tokens_and_what_base_spans_leave(spark):
    key, other = "kQ9zT3xWv7Lm2RbY5sJd8HfN1pGc4", "Zr4Kq8VnX2wPt6LsB9yMc3HdJ7gF5"
    texts = {
        f"postgres://admin:{key}@db.example.com/main": [key], f"https://{key}@example.com/x": [key], f"amqp://u:{key}@host": [key],
        f"head.{key}.{other}": [key, other], f"see {key}.{other}.": [key, other], f"end of text.{key}": [key], f"@{key}": [key], f"u@{key}": [key],
        f"{key}0123456789abcdef{other}": [key, other],
        f"{key}@example.com": [], f"mail joe@{key}.example.com now": [], f"https://www.example.com/a/{key}": [], f"www.example.com/a/{key}": [], f"http://host:8080/{key}": [],
    }
    got = {r.doc_id: r.spans for r in secrets.find_secrets(frame(spark, list(enumerate(texts)))).collect()}
    for i, (text, keys) in enumerate(texts.items()):
        places = [x.split(":") for x in got[i].split(",") if x.startswith("entropy")]
        found = [text[int(a) : int(b)] for _, a, b in places]
        assert len(found) == len(keys) and all(f in k and len(f) >= len(k) - 2 for f, k in zip(found, keys, strict=True)), (text, found)


def test_incremental_entropy_equals_direct_count():
    import math
    from collections import Counter

    rng = random.Random(9)
    run = "".join(rng.choice("abcdefAB0123456789") for _ in range(120)) + "a" * 30 + "0a1b2c3d4e5f6789fedc"
    window, alphabet, needs, least = secrets.CLASSES["base36"]
    direct = set()
    for i in range(len(run) - window + 1):
        part = run[i : i + window]
        h = -sum(n / window * math.log2(n / window) for n in Counter(part).values())
        if set(part) <= alphabet and h >= least - 1e-9 and any(c.isdigit() for c in part) and any(c.islower() for c in part):
            direct.update(range(i, i + window))
    assert {i for a, b in secrets.entropy_windows(run, window, alphabet, needs, least) for i in range(a, b)} == direct


def test_digest_of_nothing():
    assert brute.sha("") == hashlib.sha256(b"").hexdigest()
