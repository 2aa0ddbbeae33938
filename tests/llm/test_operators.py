"""Brute-force, edge-case and round-trip tests of the training-data operators."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordwise.llm import (
    components,
    html_region,
    lang_id,
    minhash_forest,
    mixing,
    ngram_trie,
    packing,
    quality_rules,
    registry,
    suffix_dedup,
    vector_graph,
    warc_revisit,
)
from ordwise.llm import words as W
from ordwise.llm.store import ship
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, comp long"


def _words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8))) for _ in range(n))


def _docs(spark):
    """Nulls in every column, empty, white space, long, ties, repeated rows, clashing names."""
    ship(spark)
    long_text = _words(1, 3000)
    texts = [None, "", " \n\t", "one", "a b c d", long_text, long_text, long_text + " tail word", _words(2, 40),
             _words(2, 40), _words(3, 300), "x" * 500, _words(4, 60) + "\n" + _words(4, 60), "café 你好   \U0001f600 end"]
    rows = [(i, t, ["en", "fr", None][i % 3], ["s1", "s2", None][i % 3], None if t is None else len(t), 7, "x", 1)
            for i, t in enumerate(texts)]
    rows += [rows[8], (None, _words(5, 50), None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark)


@pytest.mark.parametrize("key", sorted(registry.ORACLE_SQL))
def test_matches_duckdb(spark, duck_small, key):
    ok, msg = compare(registry.QUERIES[key](spark, SF_SMALL), duck_small, registry.ORACLE_SQL[key])
    assert ok, msg


def test_split_words_is_the_pattern():
    texts = ["", " a\x0bb\x00c ", " x y", "end\n", "a" * 30 + " " + "a" * 31, "z"]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0] + [len(r) for r in raw])
    w = W.split_words(np.frombuffer(b"".join(raw), np.uint8), offs)
    got = [[b"".join(raw)[s:e] for s, e, r in zip(w.start, w.end, w.row) if r == k] for k in range(len(raw))]
    assert got == [re.findall(rb"[^\x20\x09-\x0D]+", r) for r in raw]
    assert len(set(w.hash.tolist())) == len({x for g in got for x in g})


# -- 1 ----------------------------------------------------------------------------------

def _brute_removed(rows, span=suffix_dedup.SPAN):
    """rows: (order, bytes) in order; copies of an id are one document."""
    first = {}
    for order, data in rows:
        for i in range(len(data) - span + 1):
            key = data[i: i + span]
            if key not in first or (order, i) < first[key]:
                first[key] = (order, i)
    out = []
    for order, data in rows:
        gone = bytearray(len(data))
        for i in range(len(data) - span + 1):
            if first[data[i: i + span]] < (order, i):
                gone[i: i + span] = b"\x01" * span
        out.append(gone)
    return out


def _check_suffix(spark, pairs):
    ship(spark)
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    got = sorted(suffix_dedup.dedup_report(df).collect(), key=str)
    ties = {r.text: r.tie for r in df.selectExpr("coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS tie").collect()}
    order = [((2 ** 63 - 1 if i is None else i, ties[t or ""]), (t or "").encode()) for i, t in pairs]
    want = []
    for (i, _), (_, data), gone in zip(pairs, order, _brute_removed(order)):
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


def test_suffix_dedup_edges(spark, docs):
    _check_suffix(spark, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_suffix_dedup_edited_copies(spark):
    r = random.Random(5)
    base = [_words(100 + k, 120) for k in range(4)]
    pairs = []
    for i in range(60):
        t = list(r.choice(base))
        for _ in range(r.randint(0, 6)):
            t[r.randrange(len(t))] = r.choice("XYZ")
        cut = r.randrange(len(t))
        pairs.append((i, "".join(t[cut:] + t[:cut]) + r.choice(["", "ab" * 120, base[0][50:151], base[1][7:106]])))
    _check_suffix(spark, pairs)


def test_suffix_dedup_shared_and_null_ids(spark):
    """Different texts of one id, of no id and of the greatest id, of different lengths."""
    a, b = _words(300, 200), _words(301, 90)
    pairs = [(5, a), (5, a[:400]), (5, b + a[100:350]), (3, b), (5, a), (None, b + a), (None, a[200:]), (None, None), (2 ** 63 - 1, a[30:330]),
             (5, ""), (7, b[40:] + b[:300]), (None, b + a)]
    _check_suffix(spark, pairs)
    rows = spark.createDataFrame([(i, t, "x", None if t is None else len(t)) for i, t in pairs], "doc_id long, text string, doc string, n_chars long")
    out = suffix_dedup.apply_dedup(rows)
    got = sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in out.collect()), key=str)
    want = suffix_dedup.dedup_report(rows.select("doc_id", "text")).collect()
    assert got == sorted(((r.doc_id, r.kept_sha256) for r in want), key=str)


def test_suffix_dedup_long_text_in_segments(spark, monkeypatch):
    text = _words(9, 400)
    offs = np.array([0, len(text)])
    whole = list(suffix_dedup.units(offs, 500))
    starts = [int(s[0]) for _, _, s in whole]
    assert len(whole) > 2 and starts == list(range(0, len(text) - suffix_dedup.SPAN + 1, 500))
    assert all(b[1] - b[0] <= 500 + suffix_dedup.SPAN - 1 for _, b, _ in whole)


def test_suffix_dedup_keeps_columns(docs):
    out = suffix_dedup.apply_dedup(docs)
    assert out.columns == docs.columns and out.count() == docs.count()


# -- 2 ----------------------------------------------------------------------------------

def test_quality_measures_brute(spark, docs):
    for r in quality_rules.measured(docs.select("doc_id", "text"), "text").collect():
        t = r.text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(ws[i: i + 5]) for i in range(len(ws) - 4))
        at = {i + k for i in range(len(ws) - 4) if grams[tuple(ws[i: i + 5])] > 1 for k in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(at))


def test_host_verdict_needs_host_and_document(spark):
    ship(spark)
    clean, junk = _words(1, 50), " ".join(w + "###" for w in _words(2, 50).split())
    rows = [(i, clean, "good") for i in range(400)] + [(1000, junk, "good")]
    rows += [(2000 + i, junk if i % 2 else clean, "bad") for i in range(100)] + [(3000, clean, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id for r in quality_rules.apply_rules(df).collect()}
    assert 1000 in kept and 3000 in kept and set(range(400)) <= kept
    assert {i for i in range(2000, 2100) if i in kept} == set(range(2000, 2100, 2))


def test_quality_edges(docs):
    out = quality_rules.apply_rules(docs)
    assert out.columns == docs.columns
    assert quality_rules.apply_rules(docs.limit(0)).count() == 0


# -- 3 ----------------------------------------------------------------------------------

PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies ok</div>
<article><h1>Big &amp; title</h1><p>First   para with <b>bold</b> words and more of them here.<p>Second &lt;para&gt;
goes on<br>and on for a while.</p><div class="ad">Buy this now please</div><aside>Side</aside>
<p>Third one ends it.</p><section id="comments"><p>Nice post by a reader</p></section></article>
<form><p>Sign up</p></form><footer>&copy; site words that follow here</footer></body></html>"""
TEXT = ("Big & title\n\nFirst para with bold words and more of them here.\n\nSecond <para> goes on and on for a while."
        "\n\nThird one ends it.")


def test_html_region(spark):
    ship(spark)
    bare = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    df = spark.createDataFrame([(1, "u", PAGE), (1, "u", PAGE), (2, None, bare), (3, "u", None), (4, "u", ""),
                                (None, "u", "<p>open <b"), (5, "u", "plain text")], "page_id long, url string, html string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_region.extract_pages(df).collect()]
    assert got[0] == got[1] == (1, TEXT, len(TEXT)) and got[2] == (2, TEXT, len(TEXT))
    assert got[3][1] == got[4][1] == "" and got[5][1] == "open" and got[6][1] == "plain text"
    assert html_region.extract_pages(df.limit(0)).count() == 0


def test_html_region_wrappers_and_post_headers(spark):
    """Layout words of wrappers and headers within the article are no furniture; the furniture around stays out."""
    ship(spark)
    body = "<p>Some text with quite a few words that is the content of the page.</p>" * 2
    art = f'<article><div class="post-header"><h1>The headline here</h1></div>{body}</article>'
    text = "The headline here" + "\n\nSome text with quite a few words that is the content of the page." * 2
    wraps = ["<div>%s</div>", '<div class="layout no-sidebar">%s</div>', '<div id="page" class="has-header">%s</div>',
             '<div class="content-sidebar-wrap">%s</div>', "<form>%s</form>",
             '<div class="sidebar"><article>A card</article></div><main>%s</main>',
             '%s<div class="related"><article>A card</article></div>', '%s<div class="site-header">A menu</div>']
    rows = [(i, f"<html><body>{w % art}</body></html>") for i, w in enumerate(wraps)]
    df = spark.createDataFrame([(i, "u", h) for i, h in rows], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_region.extract_pages(df).collect()} == {i: text for i, _ in rows}


def _page_weights(spark):
    """Weights fitted on all given pages, as the query fits them."""
    counts = html_region.count_tokens(spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("html")).collect()
    return html_region.weights([(r.kind, r.inside, r.n) for r in counts])


ODD_PARTS = {  # what an article ends with -> its text
    "<ul><li>Salt</li><li>Pepper</li></ul>": "Salt\n\nPepper",
    "<figure><img src=x><img src=y></figure><p>End</p>": "End",
    "<div class=gallery>" + "<figure><img src=x></figure>" * 400 + "</div><p>End</p>": "End",
    "<div class=ad>" + "buy this now " * 2000 + "</div><p>End</p>": "End",
    '<svg/><p>After the icon</p>': "After the icon",
    '<svg><path d="M0"/><title>Icon</title></svg><p>After the icon</p>': "After the icon",
    '<script src="x.js"/><p>After the script</p>': "After the script",
    '<p><svg viewBox="0"><path>unclosed</p><p>After the icon</p>': "After the icon",
    '<p data-id="related">Kept words</p>': "Kept words",
    '<section id="related-work"><h2 id="comments">Related work</h2><p>Kept words</p></section>': "Related work\n\nKept words",
    '<section class="ad-slot">Buy</section><div id="related-posts">More</div><p>Kept words</p>': "Kept words",
    "<p>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds</p>": "So x=2 holds",
    "<p>Last <a href=/next/>link</a></p>": "Last link",
}


@pytest.mark.parametrize("around", ["<article>%s</article>", "<main><div>%s</div></main>"])
def test_html_region_keeps_the_ends_of_an_article(spark, around):
    w = _page_weights(spark)
    head = "<h1>Head</h1><p>Some words of the first paragraph.</p>"
    for part, text in ODD_PARTS.items():
        page = f"<body><nav><a>Home</a></nav>{around % (head + part)}<footer>Foot words</footer></body>"
        assert html_region.extract(page, w) == "Head\n\nSome words of the first paragraph.\n\n" + text, part


def test_html_region_without_a_content_element(spark):
    """Short last blocks stay in, an unnamed list of links stays out."""
    w = _page_weights(spark)
    menu = "<ul>" + "".join(f"<li><a href=x>{x}</a></li>" for x in ("Home", "About us", "News")) + "</ul>"
    body = "<h1>Head</h1><p>Some words of the first paragraph.</p><img src=x><p>Short</p><ul><li>Salt</li><li>Pepper</li></ul>"
    assert html_region.extract(f"<body>{menu}<div>{body}</div>{menu}</body>", w) == (
        "Head\n\nSome words of the first paragraph.\n\nShort\n\nSalt\n\nPepper")


def test_html_region_against_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        x = [rng.randint(-4, 4) for _ in range(rng.randint(0, 14))]
        runs = [(sum(x[i:j]), -j, i) for i in range(len(x)) for j in range(i + 1, len(x) + 1)]
        total, end, start = max(runs, default=(0, 0, 0))
        assert html_region.best_region(x) == ((start, -end) if total > 0 else (0, 0))


def test_html_region_on_given_pages(spark):
    import html
    rows = {r.page_id: r for r in html_region.q_html_region(spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    for p in pages:
        inner = p.html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        parts = (" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert rows[p.page_id].text == "\n\n".join(x for x in parts if x)
    assert len(rows) == len(pages)


# -- 4 ----------------------------------------------------------------------------------

def test_lang_id_held_out(spark):
    got = {r.doc_id: r for r in lang_id.q_lang_id(spark, SF_SMALL).collect()}
    truth = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").collect()
    held = [r for r in truth if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert all(got[r.doc_id].held_out for r in held) and sum(g.held_out for g in got.values()) == len(held)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= g.score <= 1 for g in got.values())


def test_lang_id_edges(spark, docs):
    d = lang_id.with_fold(docs, 4, 2)
    model = lang_id.fit(d.where("lang is not null and text is not null"))
    out = lang_id.predict(d, model).collect()
    assert len(out) == docs.count()
    assert {r.lang_pred for r in out if r.doc_id in (0, 1, 2)} == {"und"}
    empty = lang_id.fit(d.where("false"))
    assert {r.lang_pred for r in lang_id.predict(d, empty).collect()} == {"und"}


def _lang_brute(learn, text):
    """Language and posterior from plain counters, by the method's rules."""
    letters = [x for x in re.split(r"[\W\d_]+", (text or "").lower()) if x]
    langs = sorted({lang for lang, _ in learn})
    if not letters or not langs:
        return "und", 0.0
    table = {(lang, k): Counter() for lang in langs for k in range(6)}
    for lang, known in learn:
        for x in re.split(r"[\W\d_]+", known.lower()):
            if x:
                table[lang, 0][x] += 1
                for k in range(1, 6):
                    y = f"<{x}>" if k > 1 else x
                    table[lang, k].update(y[i:i + k] for i in range(len(y) - k + 1))
    total = {key: sum(c.values()) + 1 for key, c in table.items()}
    log = lambda lang, k, x: math.log((table[lang, k][x] or 0.5) / total[lang, k])
    known = lambda k, x: any(table[lang, k][x] for lang in langs)
    sums = dict.fromkeys(langs, 0.0)
    for x in letters:
        if known(0, x):
            k, items = 0, [x]
        else:
            for k in (5, 4, 3, 2, 1):
                y = f"<{x}>" if k > 1 else x
                items = [g for g in (y[i:i + k] for i in range(len(y) - k + 1)) if known(k, g)]
                if items:
                    break
        for lang in langs if items else ():
            sums[lang] += sum(log(lang, k, g) for g in items) / len(items)
    top = max(sums.values())
    best = min(lang for lang in langs if sums[lang] == top)
    return best, 1 / sum(math.exp(v - top) for v in sums.values())


def test_lang_id_against_brute_force(spark):
    rng = random.Random(5)
    make = lambda abc, n: " ".join("".join(rng.choice(abc) for _ in range(rng.randint(1, 6))) for _ in range(n))
    learn = [("a", make("abcd", 60)), ("b", make("cdef", 40)), ("c", make("efgh", 80)), ("a", "Long" * 40), ("c", "7 _ !")]
    asked = [make("abcdefghij", n) for n in (1, 2, 3, 5, 8, 13)] * 2 + [make("xyz", 3), "long" * 40, "long" * 39, None, "", "12 _"]
    rows = [(i, lang, t) for i, (lang, t) in enumerate(learn)]
    model = lang_id.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))
    df = spark.createDataFrame([(i, False, t) for i, t in enumerate(asked)], "doc_id long, held_out boolean, text string")
    for r in lang_id.predict(df, model).collect():
        lang, score = _lang_brute(learn, asked[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - score) < 1e-4, asked[r.doc_id]


def test_lang_id_scores_the_whole_of_a_long_word(spark):
    learn = spark.createDataFrame([(1, "x", "abababab babababa"), (2, "y", "cdcdcdcd dcdcdcdc")], "doc_id long, lang string, text string")
    asked = spark.createDataFrame([(3, False, "abab" * 16 + "cdcd" * 2000)], "doc_id long, held_out boolean, text string")
    assert lang_id.predict(asked, lang_id.fit(learn)).first().lang_pred == "y"


# -- 5 ----------------------------------------------------------------------------------

def test_canonical_url(spark):
    urls = ["http://WWW.Ex.com:80/a/?b=2&a=1&utm_x=3#f", "https://ex.com/a?a=1&b=2&ref=q", "https://m.ex.com", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(warc_revisit.canonical_url(df.u)).collect()] == ["ex.com/a?a=1&b=2"] * 2 + ["ex.com", None]


@pytest.mark.parametrize("span", [1, 7, 1 << 16])
def test_revisits_brute(spark, span):
    r = random.Random(3)
    recs = []
    for i in range(300):
        h = {"content-type": "t", "date": str(i)}
        if r.random() < 0.7:
            h["etag"] = r.choice(["W/", ""]) + r.choice("ab")
        if r.random() < 0.3:
            h["last-modified"] = r.choice("12")
        recs.append((i, r.choice(["http://x.com/", "https://www.x.com", "http://y.com/q", None]),
                     None if r.random() < 0.05 else r.randrange(60), r.choice(["response", "revisit"]), h))
    recs.append(recs[5])
    df = spark.createDataFrame(recs, "record_id long, url string, at long, kind string, headers map<string,string>")
    got = {(x.record_id, x.resolved_id, x.status, tuple(sorted((x.headers or {}).items())))
           for x in warc_revisit.resolve(df, span).collect()}
    site = {"http://x.com/": "x", "https://www.x.com": "x", "http://y.com/q": "y"}
    want = set()
    for i, u, at, kind, h in recs:
        if kind != "revisit":
            continue
        old = [x for x in recs if x[3] == "response" and u and site.get(x[1]) == site[u]
               and at is not None and x[2] is not None and x[2] < at]
        if not old:
            want.add((i, None, "missing", ()))
            continue
        full = max(old, key=lambda x: (x[2], x[0]))
        tag = lambda x: x.get("etag", "").removeprefix("W/") or None
        a, b, c, d = tag(h), tag(full[4]), h.get("last-modified"), full[4].get("last-modified")
        same = a == b if a and b else (a is None and (c is None or d is None or c == d))
        merged = {**full[4], **{k: v for k, v in h.items() if k in warc_revisit.PERMITTED}}
        want.add((i, full[0], "resolved", tuple(sorted(merged.items()))) if same else (i, full[0], "mismatch", ()))
    assert got == want


# -- 6 ----------------------------------------------------------------------------------

def test_elias_fano_level(tmp_path):
    r = np.random.default_rng(1)
    for k, values in enumerate([np.unique(r.integers(0, 1 << 62, 5000).astype(np.uint64)), np.array([0], np.uint64),
                                np.arange(1000, dtype=np.uint64), np.zeros(0, np.uint64),
                                np.unique(r.integers(0, 5000, 3000).astype(np.uint64))]):
        level = ngram_trie.Level(str(tmp_path / str(k)), values)
        assert level.find(values).tolist() == list(range(len(values)))
        probe = r.integers(0, 1 << 62, 500).astype(np.uint64)
        place = {int(v): i for i, v in enumerate(values)}
        assert level.find(probe).tolist() == [place.get(int(p), -1) for p in probe]


def test_ngram_base_score_and_edges(spark, docs):
    d = lang_id.with_fold(docs.select("doc_id", "text"), 10, 0)
    low = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s or "")
    rows = d.collect()
    toks = [low(r.text).encode().split() + [None] for r in rows]
    c = Counter()
    for r, t in zip(rows, toks):
        if not r.held_out:
            c.update(t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(r.doc_id), len(t), sum(c[w] > 0 for w in t),
                   round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for r, t in zip(rows, toks))
    got = ngram_trie.score(d).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n} and all(r.score < 0 for r in got)
    none = ngram_trie.score(d.withColumn("held_out", d.held_out.isNotNull())).collect()
    assert {r.train_tokens for r in none} == {0} and {r.n_known for r in none} == {0}


def test_ngram_model_is_better_and_brute_force(spark):
    """The sharded trie's scores against a dictionary version of the same model."""
    ship(spark)
    r = random.Random(8)
    vocab = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join(r.choice(vocab[: 5 + 7 * (i % 5)]) for _ in range(r.randint(0, 30))), i % 4 == 0) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    got = {x.doc_id: x.score for x in ngram_trie.score(df).collect()}
    counts = ngram_trie.count_pass(df)
    tab = ngram_trie.tables(counts)
    c1, c2, c3 = Counter(), Counter(), Counter()
    grams = {}
    for i, t, held in rows:
        buf = np.frombuffer(t.encode(), np.uint8)
        w, v, u, _ = ngram_trie.tokens(buf, np.array([0, len(buf)]))
        g = tab.class_of(v, tab.heavy_at(v))
        grams[i] = list(zip(w.tolist(), g.tolist(), ngram_trie.context(u, v).tolist()))
        if not held:
            for a, b, h in grams[i]:
                c1[a] += 1
                c2[a, b] += 1
                c3[a, b, h] += 1
    assert sum(tab.contexts) == sum(c1.values())

    def log_p(a, b, h):
        p = float(tab.p1(np.array(c1[a])))
        for c, total, m in ((c2[a, b], tab.classes[b], ngram_trie.M2), (c3[a, b, h], tab.contexts[h], ngram_trie.M3)):
            p = float(ngram_trie.smooth(np.array(c), np.array(total), p, m))
        return math.log10(p)

    for i, gs in grams.items():
        assert abs(got[i] - sum(log_p(*x) for x in gs)) <= 0.001 * len(gs)


def test_ngram_rare_histories_keep_counts_of_their_own(spark):
    """Exact scores of plain dictionaries over the words themselves, with words and pairs on both sides of
    the frequent ones' border: no history shares its counts with another."""
    ship(spark)
    r = random.Random(31)
    vocab = [f"w{k}" for k in range(9000)]
    rows = [(i, " ".join(vocab[int(9000 * r.random() ** 3)] for _ in range(r.randint(0, 400))), i % 5 == 0) for i in range(300)]
    df = spark.createDataFrame(rows + [(None, "w1 w2", False), (7, None, False)], "doc_id long, text string, held_out boolean")
    c1, c2, c3 = Counter(), Counter(), Counter()

    def grams(text):
        t = ["<", "<", *(text or "").split(), ">"]
        return list(zip(t, t[1:], t[2:]))

    for _, text, held in [*rows, (None, "w1 w2", False), (7, None, False)]:
        if not held:
            for u, v, w in grams(text):
                c1[w] += 1
                c2[v, w] += 1
                c3[u, v, w] += 1
    total2, total3 = Counter(), Counter()
    for (v, _), k in c2.items():
        total2[v] += k
    for (u, v, _), k in c3.items():
        total3[u, v] += k
    n = sum(c1.values())
    assert len(total2) > 5000 and len(total3) > 20000 and min(total2.values()) * ngram_trie.HEAVY < n < max(total3.values()) * ngram_trie.HEAVY

    def log_p(u, v, w):
        p = (c1[w] + 0.1) / (n + 0.1 * (len(c1) + 1))
        for c, total, m in ((c2[v, w], total2[v], ngram_trie.M2), (c3[u, v, w], total3[u, v], ngram_trie.M3)):
            k = m[0] * total ** m[1] if total else 1.0
            p = (c + k * p) / (total + k)
        return math.log10(p)

    want = Counter((i, round(sum(log_p(*g) for g in grams(text)), 5)) for i, text, _ in [*rows, (None, "w1 w2", False), (7, None, False)])
    assert Counter((x.doc_id, round(x.score, 5)) for x in ngram_trie.score(df).collect()) == want


# -- 7 ----------------------------------------------------------------------------------

def test_vector_graph_edges(spark):
    ship(spark)
    nan = float("nan")
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.1], 1), (4, v, 2), (5, None, 1), (6, [0.0] * 3, 1), (7, [nan, 1.0, 1.0], 1),
            (8, [None, 1.0, 1.0], 1), (9, v, None), (10, [1.0, 2.0], 1), (11, [], 1), (12, [-1.0, -2.0, -3.0], 1), (None, v, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_graph.near_vectors(df).collect()}
    assert got[1] == got[2] == got[3] == (2, 1)
    assert {k: x for k, x in got.items() if k not in (1, 2, 3)} == {k: (0, k) for k in (4, 5, 6, 7, 8, 9, 10, 11, 12, None)}
    assert vector_graph.near_vectors(df.limit(0)).count() == 0


def test_vector_graph_recall(spark, monkeypatch):
    """Shards, parts and search against all pairs, with small shards so that all are in use."""
    ship(spark)
    r = np.random.default_rng(4)
    base = r.normal(size=(400, 32))
    rows = [(i, (base[i % 400] + (0.05 if i >= 400 else 0) * r.normal(size=32)).tolist(), i % 2) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(vector_graph, "SHARD", 100)
    monkeypatch.setattr(vector_graph, "MEMBERS", 150)
    reps = vector_graph.usable(df)
    links = {(x.a, x.b) for x in vector_graph.graph_links(reps, vector_graph.fit_centroids(reps), 3).collect()}
    x = np.array([v for _, v, _ in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    truth = {(i, j) for i, j in zip(*np.nonzero(s >= vector_graph.COSINE)) if i < j and i % 2 == j % 2}
    assert links <= truth and len(links) >= 0.99 * len(truth) > 0


@pytest.mark.parametrize("overlap,members", [(2, 8000), (3, 20)])
def test_vector_graph_counts_and_borders(spark, monkeypatch, overlap, members):
    """Sums a vector, the spanning links and the search across borders against all pairs: dense
    groups that many shards cut, of vectors with sizes, in two parts."""
    ship(spark)
    r = np.random.default_rng(9)
    base = r.normal(size=(8, 24))
    x = np.array([base[i % 8] + 0.12 * r.normal(size=24) for i in range(800)])
    rows = [(7 * i, x[i].tolist(), i % 2, 1 + i % 3) for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, size long")
    monkeypatch.setattr(vector_graph, "SHARD", 30)
    monkeypatch.setattr(vector_graph, "MEMBERS", members)
    reps = vector_graph.usable(df).join(df.select("vec_id", "size"), "vec_id")
    centres = vector_graph.fit_centroids(reps)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= vector_graph.COSINE) & (np.arange(800) % 2 == np.arange(800)[:, None] % 2)
    truth = {(7 * i, 7 * j) for i, j in zip(*np.nonzero(near)) if i < j}
    assert len(truth) > 1000
    pairs = [(p.a, p.b) for p in vector_graph.graph_links(reps, centres, overlap).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) <= truth and len(pairs) >= 0.99 * len(truth)
    far, span = vector_graph.graph_counts(reps, centres, overlap)
    want: dict[int, int] = {}
    for a, b in pairs:
        want[a] = want.get(a, 0) + 1 + b // 7 % 3
        want[b] = want.get(b, 0) + 1 + a // 7 % 3
    assert {p.vec_id: p.far for p in far.collect()} == want
    assert _classes(span.select("a", "b").collect()) == _classes(pairs)
    if overlap == 2:  # some pairs share no shard
        found = vector_graph.search_shards(reps, centres, overlap)
        assert vector_graph.border_links(reps, found).count() > 0


def _classes(links):
    low: dict[int, int] = {}

    def find(k):
        while low.setdefault(k, k) != k:
            k = low[k]
        return k

    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {k: find(k) for k in list(low)}


def test_vector_graph_audit(spark, monkeypatch):
    """Recall is a mean over all audit vectors with links, and a short one after the last rebuild fails."""
    ship(spark)
    r = np.random.default_rng(5)
    base = r.normal(size=(5, 32))
    rows = [(i, (base[0] + 0.001 * r.normal(size=32)).tolist(), 1) for i in range(100, 141)]
    for k in range(1, 5):
        rows += [(100 * (k + 1) + j, (base[k] + 0.001 * r.normal(size=32)).tolist(), 1) for j in (0, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    reps = vector_graph.usable(df).withColumn("size", F.lit(1).cast("long"))
    found = spark.createDataFrame([(100, 40), (200, 1), (201, 1)] + [(i, 1) for i in range(101, 141)], "vec_id long, far long")
    span = spark.createDataFrame([(100, 101)], "a long, b long")
    for block in (2, 5000):
        monkeypatch.setattr(vector_graph, "AUDIT", block)
        assert vector_graph.audit(reps, found) == pytest.approx(2 / 5)
    monkeypatch.setattr(vector_graph, "graph_counts", lambda *_: (found, span))
    with pytest.raises(RuntimeError, match="recall"):
        vector_graph.near_vectors(df)


# -- 8 ----------------------------------------------------------------------------------

def test_fit_budget_is_exact_where_lengths_allow():
    r = random.Random(2)
    for _ in range(60):
        lengths = r.sample(range(1, 40), r.randint(1, 8))
        counts = [r.randint(1, 6) for _ in lengths]
        total = sum(a * b for a, b in zip(lengths, counts))
        budget = r.randint(0, total)
        got = mixing.fit_budget(lengths, counts, budget)
        assert all(0 <= g <= c for g, c in zip(got, counts))
        reach = {0}
        for a, b in zip(lengths, counts):
            reach = {x + a * k for x in reach for k in range(b + 1)}
        taken = sum(a * g for a, g in zip(lengths, got))
        assert abs(taken - budget) <= max(lengths)
        if len(lengths) > 4 and budget in reach and min(lengths) == 1:
            assert abs(taken - budget) <= 1


def test_mix_targets_and_edges(spark, docs):
    rows, targets, picks = mixing.mix_plan(docs)
    got = mixing.with_taken(rows, picks).collect()
    assert len(got) == docs.count()
    size = Counter()
    for r in got:
        size[r.src, r.src_null] += r["size"]
    order = sorted(size, key=lambda k: (k[1], k[0]))
    weight = {k: mixing.WEIGHTS[i % 3] for i, k in enumerate(order)}
    want, total = {}, sum(size.values())
    while True:
        free = [k for k in order if k not in want]
        left = total - sum(want.values())
        share = {k: left * weight[k] / sum(weight[x] for x in free) for k in free}
        over = [k for k in free if share[k] > 3 * size[k]]
        if not over:
            want.update(share)
            break
        want.update({k: 3 * size[k] for k in over})
    for t in targets.collect():
        assert abs(t.target - want[t.src, t.src_null]) < 1e-6
        taken = sum(r.times * r["size"] for r in got if (r.src, r.src_null) == (t.src, t.src_null))
        assert abs(taken - t.target) <= max((r["size"] for r in got if (r.src, r.src_null) == (t.src, t.src_null)), default=0)
    assert all(r.times <= 3 and (r["size"] > 0 or r.times == 0) for r in got)
    again = mixing.apply_mix(docs)
    assert again.columns == docs.columns
    assert sorted(map(str, again.collect())) == sorted(map(str, mixing.apply_mix(docs).collect()))
    assert mixing.apply_mix(docs.limit(0)).count() == 0


def test_mix_bins_pick_the_same_count(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(mixing, "BIN_ROWS", 16)
    df = spark.range(3000).selectExpr("id as doc_id", "'a b c' as text", "if(id % 3 = 0, 's1', 's2') as source")
    rows, targets, picks = mixing.mix_plan(df)
    got = {r.src: r.t for r in mixing.with_taken(rows, picks).groupBy("src").agg({"times": "sum"}).toDF("src", "t").collect()}
    for t in targets.collect():
        assert abs(3 * got[t.src] - t.target) <= 3


# -- 9 ----------------------------------------------------------------------------------

def _path():
    public = pytest.importorskip("public_tokenizers")
    return public.path(packing.TOKENIZER)


def test_word_tokenizer_is_the_tokenizer():
    from tokenizers import Tokenizer
    path = _path()
    full, own = Tokenizer.from_file(path), packing.WordTokenizer(path)
    for t in ["Hello, World!", "café ÉTÉ naïve", "don't I'LL we've", "a b  c\td", "ß İ ΣΣ 你好 \U0001f600",
              "x1y22 3.14%", "é ́ x", "<|endoftext|> a<|startoftext|>b", "", "''' 's", "ǅ ﬁ ªµ"]:
        assert np.frombuffer(own.text(t.encode()), "<u4").tolist() == full.encode(t, add_special_tokens=False).ids, t


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(_path())
    for limit in (64, 2048):
        got = packing.pack(docs, _path(), limit).collect()
        want = Counter()
        for r in docs.collect():
            ids = (full.encode(r.text, add_special_tokens=False).ids if r.text else []) + [packing.END_ID]
            for k, at in enumerate(range(0, len(ids), limit)):
                part = np.array(ids[at: at + limit], "<u4")
                want[r.doc_id, k, at, len(part), zlib.crc32(part.tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        seqs = {}
        for r in got:
            seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for parts in seqs.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= limit
        assert len(seqs) <= 1.05 * -(-sum(r.length for r in got) // limit) + 1
    assert packing.pack(docs.limit(0), _path()).count() == 0


def test_plan_uses_up_the_histogram():
    r = np.random.default_rng(3)
    for _ in range(10):
        hist = r.integers(0, 30, 257) * (r.random(257) < 0.3)
        hist[0] = 0
        used = np.zeros(257, int)
        for lengths, n in packing.plan(hist, 256):
            assert sum(lengths) <= 256
            for s in lengths:
                used[s] += n
        assert (used == hist).all()


# -- 10 ---------------------------------------------------------------------------------

def _brute_groups(rows):
    sets = []
    for _, t in rows:
        ws = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").encode().split()
        sets.append({tuple(ws[i: i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set())
    label = [i for i, _ in rows]
    changed = True
    links = [(a, b) for a in range(len(rows)) for b in range(a) if rows[a][0] is not None and rows[b][0] is not None
             and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted(((i, len(s), c) for (i, _), s, c in zip(rows, sets, label)), key=str)


def test_minhash_edges(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in minhash_forest.near_groups(docs.select("doc_id", "text")).collect()), key=str)
    assert got == _brute_groups(rows)
    out = minhash_forest.dedup(docs)
    assert out.columns == docs.columns
    assert minhash_forest.near_groups(docs.limit(0).select("doc_id", "text")).count() == 0


def test_minhash_hot_group(spark):
    """A dense group, read at greater depth, with documents at the threshold around it."""
    ship(spark)
    r = random.Random(11)
    base = _words(50, 150).split()
    rows = []
    for i in range(160):
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 7])):
            w[r.randrange(len(w))] = f"edit{r.random()}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, _words(200 + i // 2, 80)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(x) for x in minhash_forest.near_groups(df).collect()), key=str)
    assert got == _brute_groups(rows)


def test_minhash_shared_ids(spark):
    """Rows that share an id, or have none, keep the links of each of their texts."""
    ship(spark)
    a, b, c = (_words(70 + k, 60) for k in range(3))
    rows = [(9, a), (9, b), (4, a + " tail"), (3, b + " tail"), (8, c), (8, c), (None, a), (None, b), (2, c + " x"), (9, ""), (1, None)]
    got = sorted((tuple(x) for x in minhash_forest.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == _brute_groups(rows)
    assert {x[2] for x in got if x[0] == 9 and x[1]} == {3, 4}


def test_minhash_copies_edited_at_one_place(spark):
    """Members of a dense region that agree to the greatest depth, over several ranges of the order."""
    ship(spark)
    base = _words(60, 1000).split()
    rows = [(7 * i + 3, " ".join([*base[:500], f"page{i}", *base[501:]])) for i in range(130)]
    got = minhash_forest.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 130 and {r.component_id for r in got} == {3}


def test_minhash_members_alone_at_greater_depth(spark):
    """A member of a dense region that shares no longer prefix keeps its neighbours there."""
    ship(spark)
    base = _words(61, 100).split()
    rows = [(5 * i + 2, " ".join([*base[:50], f"page{i}", *base[51:]])) for i in range(300)]
    got = minhash_forest.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 300 and {r.component_id for r in got} == {2}


def test_minhash_sorted_pairs_brute(spark):
    """Ranges with carried borders against one scan, with runs longer than a range."""
    ship(spark)
    r = random.Random(12)
    rows, comp = [], 0
    for i in range(600):
        comp = comp if r.random() < (0.98 if 200 < i < 400 else 0.3) else r.randrange(6)
        rows.append((i // 450, i // 7, i % 7 // 3, 0, i, comp))
    df = spark.createDataFrame(rows, "h4 long, h8 long, h16 long, h32 long, id long, comp long")
    for near in (2, 3):
        want = set()
        for key in (0, 1):
            x = [(i, c) for k, _, _, _, i, c in rows if k == key]
            ends = [x[j] for j in range(len(x)) if j in (0, len(x) - 1) or not x[j - 1][1] == x[j][1] == x[j + 1][1]]
            want |= {(a, b) for j, (b, c) in enumerate(ends) for a, d in ends[max(j - near, 0): j] if c != d}
        got = {(p.a, p.b) for p in minhash_forest.sorted_pairs(df, near).collect()}
        assert want <= got and len(got) < len(want) + 8 * 8 * near
        raw = {(a, b) for key in (0, 1) for x in [[(i, c) for k, _, _, _, i, c in rows if k == key]]
               for j, (b, c) in enumerate(x) for a, d in x[max(j - near, 0): j] if c != d}
        both = {(p.a, p.b) for p in minhash_forest.sorted_pairs(df, near, members=True).collect()}
        assert want | raw <= both and len(both) < len(want | raw) + 8 * 16 * near


def _star(seed, n, words=100):
    """A text and copies edited so that most are linked to the text alone."""
    r = random.Random(seed)
    base = _words(seed, words).split()
    out = [base]
    for k in range(1, n):
        w = list(base)
        for at in r.sample(range(words), r.choice([1, 2, 2, 3, 3])):
            w[at] = f"edit{k}x{at}"
        out.append(w)
    return [" ".join(w) for w in out]


def test_minhash_many_copies_of_one_text(spark):
    """Copies whose only link is to one member of a large group, beside a group whose common text is missing."""
    ship(spark)
    texts = [*_star(70, 450), *_star(71, 90)[1:], *(_words(300 + k, 30) for k in range(20))]
    rows = [(3 * i + 1, t) for i, t in enumerate(texts)]
    random.Random(13).shuffle(rows)
    got = sorted((tuple(x) for x in minhash_forest.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == _brute_groups(rows)


def test_minhash_shared_counts():
    r = np.random.default_rng(14)
    for n, m, names, size in ((1, 1, 4, 3), (3, 4, 50, 20), (70, 60, 400, 100), (80, 90, 9000, 200)):
        pool = r.integers(0, 1 << 62, names, dtype=np.uint64)
        x, y = ([np.unique(r.choice(pool, r.integers(1, size))) for _ in range(k)] for k in (n, m))
        want = [[len(np.intersect1d(a, b)) for b in y] for a in x]
        assert minhash_forest.shared(x, y).tolist() == want


@pytest.mark.parametrize("whole", [1000, 5])
def test_minhash_family_blocks(spark, monkeypatch, whole):
    """All pairs of a family between different components, however many blocks it is dealt over."""
    ship(spark)
    monkeypatch.setattr(minhash_forest, "WHOLE", whole)
    monkeypatch.setattr(minhash_forest, "BLOCK_ROWS", 7)
    r = random.Random(15)
    texts = [*_star(72, 60), *_star(73, 25)]
    member = [(i, r.choice([0, 0, 0, 1000 + i]), 0) if i < 60 else (i, i // 2 * 2, 60) for i in range(85)]
    sets = [{tuple(t.split()[i: i + 5]) for i in range(96)} for t in texts]
    label = {c: c for _, c, _ in member}

    def top(c):
        while label[c] != c:
            c = label[c]
        return c

    for a in range(85):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[top(member[a][1])] = top(member[b][1])
    groups = {}
    for c in label:
        groups.setdefault(top(c), set()).add(c)
    members = spark.createDataFrame(member, "id long, comp long, fam long")
    links = minhash_forest.family_links(members, spark.createDataFrame(list(enumerate(texts)), "id long, text string"))
    exchanges = re.findall(r"hashpartitioning\((fam#[^)]*)\)", links._jdf.queryExecution().executedPlan().toString())
    assert exchanges and all(re.match(r"fam#\d+L?, i#\d+L?, j#\d+L?, ", x) for x in exchanges), exchanges
    joined = {}
    for row in components.components(links).collect():
        joined.setdefault(row.comp, set()).add(row.id)
    assert sorted(map(sorted, joined.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_components_chain_and_star(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(5, x) for x in range(6, 30)] + [(1, 1), (None, 2)]
    got = {r.id: r.comp for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 5 for i in range(5, 30)}}
