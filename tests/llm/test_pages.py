"""URLs, archives, top-k and main texts against plain versions, and the pipeline as a whole."""

import hashlib
import importlib.util
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import lines, main_text, topk, urls, warc
from orderlens.llm.common import new_folder, ready
from tests.llm import brute
from tests.llm.test_texts import frame, words

# --- urls ---

URLS = {
    "http://a.net/x": ("a.net", "/x", "net/", "block"),
    "http://WWW.Example.NET/en/1?q=/fr/#top": ("www.example.net", "/en/1", "example.net/en/", "allow"),
    "https://example.net/En/": ("example.net", "/En/", "net/", "block"),
    "https://badexample.com/de/": ("badexample.com", "/de/", None, "allow"),
    "https://x.example.com/de/": ("x.example.com", "/de/", "example.com/de/", "block"),
    "http://a.net": ("a.net", "", None, "allow"),
    "http://b.org?x=/fr/": ("b.org", "", None, "allow"),
    "http://b.org/fr/": ("b.org", "/fr/", "org/fr/", "allow"),
    "http://casino.example.com/": ("casino.example.com", "/", None, "block"),
    "http://mycasinos.example.com/": ("mycasinos.example.com", "/", None, "allow"),
    "http://cheap-pills.example.com/": ("cheap-pills.example.com", "/", None, "block"),
    "http://cheap-cheap.example.com/": ("cheap-cheap.example.com", "/", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "http://x.com/" + "é" * 50_000: ("x.com", "/" + "é" * 50_000, None, "allow"),
}


def test_urls(spark):
    pages = frame(spark, [(i, u, "mine") for i, u in enumerate(URLS)] + [(0, "http://a.net/x", "again")], "page_id long, url string, verdict string")
    rules = {"block": ("net/", "example.com/de/"), "allow": ("example.net/en/", "org/fr/")}
    got = urls.judge_urls(pages, **rules)
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == URLS
    assert got.count() == len(URLS) + 1 and got.columns.count("verdict") == 1
    assert urls.judge_urls(frame(spark, [], "page_id long, url string"), **rules).count() == 0


# --- archives ---


def test_archives_come_back_as_they_were(spark, monkeypatch):
    rng = random.Random(8)
    ends = ["\r\n", "\r", "\n", "WARC/1.1\r\n", "é", "x" * 40, "\r\n\r\n", "Content-Length: 5\r\n\r\n"]
    pages = [(i, f"http://h/{i}\r\nX: y", "".join(rng.choice(ends) for _ in range(rng.randrange(90)))) for i in range(80)]
    copy = "copy " * 300
    pages += [(i, "u", copy) for i in (200, 350, 300)] + [(None, "u", copy), (350, "u", copy), (400, None, None), (401, "u", ""), (None, None, "z" * 2000), (402, "u", "a\r\n\r\nb" * 5000)]
    table = frame(spark, pages, "page_id long, url string, html string")
    for size in (1 << 20, 700):
        path = new_folder(spark)
        chunks = warc.chunk_table(warc.plan_records(table), chunk_chars=size)
        warc.write_archives(chunks, path)
        got = warc.read_archives(spark, path).collect()
        expected = []
        for page, _, html in pages:
            raw = (html or "").encode()
            first = 350 if html == copy and page != 350 else None
            expected.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if first else "response", first))
        assert brute.as_counts(got) == brute.as_counts(expected)
    last = chunks.where("page_id = 402").orderBy("chunk").collect()
    assert len(last) == 43 and last[-1].last and last[-1].so_far == last[0].sha1 and all(len(r.data) <= 700 for r in last)


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("tail", ["\r\n", "\r\n\r\n", "\r\n\r\n\r\n", "\r", "\n", "\r\n\r", ""])
def test_archives_whose_last_payload_ends_in_line_ends(spark, parts, tail):
    """Each file's last record is a response whose payload ends in the tail."""
    pages = [(i, "u", f"page {i}{tail}") for i in range(parts)] + [(10, "u", tail)] * (parts > 1)
    path = new_folder(spark)
    for size in (1 << 20, 6):
        for i, page in enumerate(pages):
            table = frame(spark, [page], "page_id long, url string, html string", 1)
            warc.write_archives(warc.chunk_table(warc.plan_records(table), chunk_chars=size), f"{path}/{size}/{i}")
        got = warc.read_archives(spark, f"{path}/{size}/*").collect()
        assert brute.as_counts(got) == brute.as_counts((i, len(x), hashlib.sha1(x.encode()).hexdigest(), "response", None) for i, _, x in pages)


def test_archives_of_nothing(spark):
    path = new_folder(spark)
    warc.write_archives(warc.chunk_table(warc.plan_records(frame(spark, [], "page_id long, url string, html string"))), path)
    assert warc.read_archives(spark, path).count() == 0


# --- top-k ---


def test_top_k_holds_one_block_of_queries(spark, monkeypatch):
    import gc
    import weakref

    alive, read = [], topk._read_block

    def watched(*args):
        gc.collect()
        assert not [r for r in alive if r() is not None]
        block = read(*args)
        alive.append(weakref.ref(block))
        return block

    monkeypatch.setattr(topk, "_read_block", watched)
    rows = [(i, [float(i % 7), float(i % 11)]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert topk.top_k(df, F.col("vec_id") % 2 == 0, block_bytes=400).count() == 250
    assert len(alive) >= 4


@pytest.mark.parametrize("block_bytes", [64 << 20, 2000])
def test_top_k_matches_all_products(spark, block_bytes):
    rng = random.Random(6)
    rows = [(i, [rng.randrange(-3, 4) / 4 + 0.001 for _ in range(4)], "e") for i in range(130)]
    rows += [(200, None, ""), (250, [1.0, None, 0.0, 0.0], ""), (300, [float("nan")] * 4, ""), (350, [float("inf")] * 4, ""), (400, [1.0, 2.0], ""), (401, [3.0, 1.0], ""), (None, [9.0] * 4, ""), (450, [], ""), (7, rows[7][1], "")]
    df = ready(spark).createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(5)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, block_bytes=block_bytes).collect()
    sound = [(i, np.floor(256 * np.float32(v).astype(float)).astype(int)) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    expected = []
    for q, a in (s for s in sound if s[0] % 50 == 0):
        scores = sorted((-int(a @ b), i) for i, b in sound if i != q and len(a) == len(b))
        expected += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:5])]
    assert brute.as_counts(got) == brute.as_counts(expected)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_products_beyond_doubles_are_exact():
    a = np.array([[2.0**30 + 1, 2.0**29 + 3]])
    assert topk._products(a, a)[0, 0] == (2**30 + 1) ** 2 + (2**29 + 3) ** 2


# --- main text ---

PAGE = """<html><body class="with-sidebar"><header><h2>Site name of many words here</h2></header><nav><ul><li><a href="/a">One more</a></li></ul></nav>
<div class="cookie-notice">We use cookies and many other words to tell you about it at great length today</div>
<article><header><h1>The &lt;title&gt; &amp; more</h1></header><p>First   paragraph with <b>bold</b>
and a <a href="x">link</a>.<p>Unclosed one<br>goes on<!-- no > comment --></p><script>var t = "</p><p>no</p>";</script>
<form><p>Your mail address please</p></form><ul><li>point one</li><li>point two</li></ul>
<section class="commentList"><p>I like this article a lot and have many words to say about it</p></section></article>
<aside><p>Other stories that you may want to read as well</p></aside><footer>&copy; 2020 site name and words</footer></body></html>"""
MAIN = "The <title> & more\nFirst paragraph with bold and a link.\nUnclosed one goes on\npoint one\npoint two"


def test_main_text(spark):
    plain = "<div class='content'>" + "".join(f"<p>Sentence {i} of a page without an article element.</p>" for i in range(9)) + "</div>"
    pages = [(1, "u", PAGE), (1, "u", PAGE), (2, "v", f"<body><div class=ad>Buy things now</div>{plain}<footer>end of page</footer>"), (3, None, None), (4, "w", ""), (5, "w", "<p>"), (None, "w", "just text"), (6, "w", "<article>" + "<p>long" * 30_000), (7, "w", "<!-- open"), (8, "w", "a < b")]
    rows = [(*p, "mine") for p in pages]
    got = main_text.extract(frame(spark, rows, "page_id long, url string, html string, text string")).collect()
    out = {r.page_id: r.text for r in got}
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    assert out[1] == MAIN and out[2].split("\n")[0] == "Sentence 0 of a page without an article element." and len(out[2].split("\n")) == 9
    assert (out[3], out[4], out[5], out[None], out[7], out[8]) == ("", "", "", "just text", "", "a < b") and out[6].count("\n") == 29_999
    assert main_text.extract(frame(spark, [], "page_id long, url string, html string")).count() == 0


def test_run_is_the_best_one():
    """The linear scan against all runs, on random pages of words and tags."""
    rng = random.Random(4)
    costs = {"p": 0.5, "/p": 0.5, "div": 3.0, "/div": 3.0}
    for _ in range(200):
        page = "".join(rng.choice(["<p>", "</p>", "<div>", "</div>", "word ", "three more words "]) for _ in range(rng.randrange(1, 14)))
        tokens = main_text.parse(page)
        scores = [-costs[t] if t is not None else len(x.split()) for t, x, _, _ in tokens]
        best = max((sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)), default=0)
        kept = main_text.main_text(page, costs)
        runs = {tuple(x for t, y, _, _ in tokens[i:j] if t is None for x in y.split()) for i in range(len(scores)) for j in range(i, len(scores) + 1) if abs(sum(scores[i:j]) - best) < 1e-9}
        assert tuple(kept.split()) in runs


# --- the pipeline ---

pipeline = importlib.import_module("corpus_pipeline")


def test_pipeline_stages_match_plain_versions(spark, tmp_path):
    rng = random.Random(12)
    common = "A line that many documents share, word for word"
    passage = words(rng, 25, 3000)
    docs = []
    for i in range(90):
        text = ". ".join(words(rng, 12, 3000) for _ in range(5))
        if i % 6 == 0:
            text = " ".join(f"{w} {w} {w}" for w in text.split())
        if i % 4 == 1:
            text += "\n" + common
        if i % 15 == 2:
            text = text + " " + passage
        docs.append((i, text, "en", len(text)))
    docs += [(100 + i, docs[1][1].replace("w1", "w2", 1) if i else docs[1][1], "en", 1) for i in range(14)] + [(200, None, None, None), (201, "", "en", 0), (None, words(rng, 30, 3000), "de", 5)]
    schema = "doc_id long, text string, lang string, n_chars long"
    ready(spark)
    for name, df in (("documents", frame(spark, docs, schema)), ("labels", frame(spark, [(i, int(i % 6 != 0), 0) for i in range(60)], "doc_id long, quality int, toxic int")), ("benchmark", frame(spark, [(1, passage)], "item_id long, text string"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    at, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        assert k == 4 or out.columns == at.columns
        out.write.parquet(f"{tmp_path}/stage{k}")
        at = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen.append(at.collect())
    rows = [[(r.doc_id, r.text) for r in s] for s in seen[:4]]
    assert {d for d, _ in rows[0]} == {d for d, *_ in docs if d is None or d >= 90 or d % 6}
    expected = [(d, t) for d, n, gone, t in brute.kept_lines(rows[0], 10, True) if not gone or t.strip()]
    assert brute.as_counts((d, t or "") for d, t in rows[1]) == brute.as_counts(expected)
    assert all(r.n_chars == len(r.text or "") for r in seen[1])
    groups = brute.near_groups(rows[1], 5, 80)
    assert {d for d, _ in rows[2]} == {c if n else d for d, n, c in groups}
    clean = {d for d, _, hit, _ in brute.phrase_hits(rows[2], [(1, passage)], 10) if not hit}
    assert {d for d, _ in rows[3]} == clean and len(clean) < len(rows[2])
    pieces = {}
    for r in seen[4]:
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
    assert pieces.keys() == clean
    assert brute.as_counts(pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "length", "ids_crc32").collect()) == brute.as_counts((r.doc_id, r.start, r.length, r.ids_crc32) for r in seen[4])


def test_passages_of_a_few_documents_stay_in_the_first(spark, tmp_path):
    """Documents that are not alike share a line of 51 words, one of 50 words, or nothing but the passage."""
    rng = random.Random(21)
    passage, shorter, lone = words(rng, 51, 3000), words(rng, 50, 3000), words(rng, 60, 3000)
    own = {i: words(rng, 150, 3000) for i in range(8)}
    docs = [(i, f"{own[i]}\n{passage.upper() if i == 4 else passage}") for i in (3, 4, 5)]
    docs += [(i, f"{own[i]}\n{shorter}") for i in (6, 7)] + [(0, own[0]), (8, passage), (9, None), (None, lone + "\na"), (None, lone + "\nb " + own[1])]
    given = frame(spark, [(d, t, "en", len(t or "")) for d, t in docs], "doc_id long, text string, lang string, n_chars long")
    for _, stage in pipeline.STAGES[1:3]:
        given = stage(spark, given, str(tmp_path))
    got = given.collect()
    expected = [(i, f"{own[i]}\n{passage}" if i == 3 else own[i]) for i in (3, 4, 5)] + docs[3:6] + [(9, "")] + docs[-2:]
    assert brute.as_counts((r.doc_id, r.text or "") for r in got) == brute.as_counts(expected)
    assert all(r.n_chars == len(r.text or "") for r in got)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_only_lines_of_enough_words_are_dropped(spark, limit):
    rows = [(1, "a b c\nd e\n\n A B  c"), (2, "A b C\nd e\n"), (3, "x y\n\na b c"), (None, "q r s"), (None, "q r s")]
    got = lines.drop_repeated_lines(frame(spark, rows), min_docs=2, min_words=3, keep_first=True, broadcast_bytes=limit)
    assert brute.as_counts((r.doc_id, r.kept) for r in got.collect()) == brute.as_counts([rows[0], (2, "d e\n"), (3, "x y\n"), *rows[3:]])


# --- main text: marks, long pages, a plain parser ---

WORDS40 = " ".join(f"word{i}" for i in range(40))


@pytest.mark.parametrize("tag", [
    '<article class="post comments-open">', '<article class="post has-promo">', '<div class="content no-sidebar">', '<div class="page with-sidebar">',
    '<div data-id="main-menu-1">', '<article data-role="related">', '<div class="comments">', '<form id="all">',
])
def test_marks_do_not_lose_articles(tag):
    name = tag[1:].split()[0]
    assert main_text.main_text(f"<html><body>{tag}<p>{WORDS40}</p></{name}></body></html>", {}) == WORDS40


@pytest.mark.parametrize("part", [
    '<p class="advert">buy now</p>', '<p class="cookie-notice">we use cookies', '<div class="sidebar-left">side</div>', '<div id="post-comments"><p>nice</p></div>',
    '<ul><li class="share">share it</ul>', "<div hidden>gone</div>", '<div role="navigation">go</div>', '<table><tr><td class="ad">buy</table>',
])
def test_marked_parts_go(part):
    assert main_text.main_text(f"<article><p>{WORDS40}</p>{part}<p>end {WORDS40}</p></article>", {}) == f"{WORDS40}\nend {WORDS40}"


def test_marks_end_with_the_next_sibling_and_other_names_stay():
    page = f'<article><p>{WORDS40}</p><ul><li class="share">share it<li>kept</ul><section id="search-history"><p>old {WORDS40}</p></section></article>'
    assert main_text.main_text(page, {}) == f"{WORDS40}\nkept\nold {WORDS40}"


@pytest.mark.parametrize("page", [
    "<script " * 125_000, "<script>" * 125_000, "x <y " * 200_000, '<a "' * 250_000, '<a x="> y" ' * 90_000, "<svg>" * 200_000, "<!--" * 250_000, "<p class=ad>x" * 70_000,
    "<div>" * 100_000 + "</p></b>" * 50_000, "<a" + " " * 1_000_000 + ">", "<" * 1_000_000,
])
def test_long_pages_take_linear_time(page):
    import time

    start = time.time()
    main_text.main_text(page, {})
    assert time.time() - start < 10  # some 2 seconds; quadratic time would be minutes


def plain_tags(page):
    """Names of tags as the public HTML parser of the standard library sees them, without silent elements."""
    from html.parser import HTMLParser

    found, silent = [], []

    class Parser(HTMLParser):
        def handle_starttag(self, tag, attrs):
            if silent:
                return
            if tag in main_text.SILENT:
                silent.append(tag)
            else:
                found.append(tag)

        def handle_startendtag(self, tag, attrs):
            if not silent and tag not in main_text.SILENT:
                found.append(tag)

        def handle_endtag(self, tag):
            if silent:
                if silent[-1] == tag:
                    silent.pop()
            else:
                found.append("/" + tag)

        def handle_data(self, data):
            if not silent and data:
                if found and isinstance(found[-1], tuple):
                    found[-1] = (found[-1][0] + data,)
                else:
                    found.append((data,))

    p = Parser(convert_charrefs=True)
    p.feed(page)
    p.close()
    return found


def test_tags_match_a_plain_parser():
    rng = random.Random(12)
    parts = ["<p>", "</p>", "<div class='a > b'>", "</div>", '<a href="x?a=1&amp;b=<2>">', "</a>", "text &amp; more ", "<!-- <p> -->", "<br/>", "<script>if (a<b) '<p>'</script>", "<style>p > a {}</style>", "<ul><li>", "</ul>", "<IMG alt='>'>", "one ", "<!DOCTYPE html>"]
    for _ in range(300):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        got = []
        for tag, text, *_ in main_text.parse(page):
            if tag is not None:
                got.append(tag)
            elif got and isinstance(got[-1], tuple):
                got[-1] = (got[-1][0] + text,)
            else:
                got.append((text,))
        assert got == plain_tags(page), page
