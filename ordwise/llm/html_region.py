"""Main-text extraction by maximum-scoring subsequence.

A page is a sequence of word and tag tokens. A word scores positive, a tag
negative, and every token of boilerplate (menu, footer, advert, form, comment
and so on) slightly negative; one linear scan finds the contiguous region with the
highest sum. The weights are log-odds of each token kind inside and outside the
content of labelled pages: pages that mark their content with an ``article`` or
``main`` element label themselves, and tokens are counted over all of them.
Words of the region outside boilerplate are the text, in blocks.

Two bounds keep short blocks at the region's ends: a tag other than a link's costs
at most a third of a word, so that a block of one word adds to the sum, and within a
content element tags and boilerplate cost next to nothing, so that no number of
images, items or adverts cuts what follows them.

A class, id or role names furniture by any of its words outside the content element;
inside only if its other words, if any, are words of layout (``related-posts``, but
not ``related-work``), and an id of a heading or paragraph there is an anchor.

Edge cases: null or empty html gives an empty text; with no labelled page the
weights are a word against a tag at equal odds; unclosed tags, comments and raw
elements run to the end of the page; ``/>`` closes an element unless the slash belongs
to an unquoted value; text of formulas is kept without their annotations; ties go to
the region that ends first, then the shortest; repeated rows are extracted alike; a
page of any length is scanned whole; other columns are not read.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordwise.llm.store import read, saved

# Element names of the HTML standard by role.
CONTENT = {"article", "main"}
RAW = {"script", "style", "textarea", "title", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CHROME = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "label", "fieldset",
          "noscript", "template", "object", "svg", "annotation", "annotation-xml"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr",
         "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
         "th", "thead", "tr", "ul", "option"}
# Words in class, id or role that name page furniture, unless the
# word before says that the page has it or not.
FURNITURE = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "cookie", "cookies", "consent", "disqus", "footer", "header", "menu", "modal", "nav", "navbar", "navigation",
    "newsletter", "notice", "popup", "promo", "related", "share", "sharing", "sidebar", "signup", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget"}
STATES = {"no", "has", "with", "without"}
# Words of layout, which beside a word of furniture name furniture within content too.
LAYOUT = {"area", "articles", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "form",
          "group", "icons", "inner", "inline", "item", "items", "left", "link", "links", "list", "main", "panel", "posts",
          "right", "section", "slot", "stories", "thread", "top", "unit", "wrap", "wrapper"}
ANCHORS = {"h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "dt", "dd", "a", "span"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                    r"((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VALUE_END = re.compile(r"=\s*[^\s\"'>]+\Z")

_MAIN = re.compile(r"<main\b", re.I)

WORD, CHROME_WORD, LINK = "word", "chrome word", "a"
WITHIN = -1e-6


def furniture(names: str, content: bool) -> bool:
    """Whether a class, id or role names furniture; within content a header is a headline's
    and a name with a word that is neither furniture's nor layout's is the author's."""
    for name in names.lower().split():
        words = [x for x in re.split("[_-]", name) if x]
        found = [x for k, x in enumerate(words) if x in FURNITURE and not (k and words[k - 1] in STATES)
                 and not (content and x == "header")]
        if found and not (content and any(x not in FURNITURE and x not in LAYOUT and not x.isdigit() for x in words)):
            return True
    return False


def named_furniture(name: str, attributes: str, content: bool) -> bool:
    """Whether an element's class, id or role names furniture."""
    if name in CONTENT or name in ("html", "body"):
        return False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key in ("class", "role") or key == "id" and not (content and name in ANCHORS):
            if furniture(a or b or c, content):
                return True
    return False


def tokens(page: str) -> Iterator[tuple[str, str, bool, bool]]:
    """(kind, text, in content, in boilerplate): kind is WORD (a text run), a tag
    name, or a block break before it. Open elements are kept as a stack; an end
    tag closes up to its element, an unmatched one closes nothing. An open form or
    element named as furniture that turns out to hold the main element, or on pages
    without one the first article, is none."""
    stack: list[tuple[str, bool]] = []
    holds = "main" if _MAIN.search(page) else "article"
    chrome = content = 0
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[4] is not None:
            yield WORD, m[4], content > 0, chrome > 0
            continue
        if m[2] is None:
            continue
        name = m[2].lower()
        if not m[1]:
            if name == "p" and stack and stack[-1][0] == "p":
                stack.pop()
            closed_itself = m[3].endswith("/") and not _VALUE_END.search(m[3])
            bad = name in CHROME or (name == "header" and not content) or named_furniture(name, m[3], content > 0)
            if name == holds:
                holds = ""
                for k, (outer, was) in enumerate(stack):
                    if was and (outer == "form" or outer not in CHROME):
                        stack[k] = outer, False
                        chrome -= 1
            yield name, "", content > 0, chrome > 0 or bad
            if closed_itself:
                continue
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else n
            elif name not in VOID:
                stack.append((name, bad))
                chrome += bad
                content += name in CONTENT
        else:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            if depth is not None:
                for closed, bad in stack[depth:]:
                    chrome -= bad
                    content -= closed in CONTENT
                del stack[depth:]
            yield name, "", content > 0, chrome > 0


def count_tokens(pages: DataFrame) -> DataFrame:
    """(kind, inside, n) over the pages that label themselves; kinds are two word
    kinds and the element names of the standard, so the result has a fixed bound."""
    names = BLOCK | VOID | CHROME | RAW | CONTENT | {"a", "b", "i", "em", "strong", "span", "u", "small", "sup", "sub"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                if not page or not re.search(r"<(?:article|main)\b", page, re.I):
                    continue
                for kind, text, inside, chrome in tokens(page):
                    if kind == WORD:
                        total[CHROME_WORD if chrome else WORD, inside and not chrome] += len(text.split())
                    else:
                        total[kind if kind in names else "other", inside and not chrome] += 1
        rows = list(total.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for (k, _), _ in rows], pa.string()), pa.array([i for (_, i), _ in rows], pa.bool_()),
             pa.array([n for _, n in rows], pa.int64())], names=["kind", "inside", "n"])

    return pages.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))


def weights(counts: list) -> dict[str, float]:
    """Log-odds inside against outside; words at least 0.1, tags at most -0.05 and, but for
    links, no worse than a third of a word. Boilerplate is never part of the text, so its
    tokens only cost the least."""
    total: Counter = Counter()
    each: Counter = Counter()
    for kind, inside, n in counts:
        total[inside] += n
        each[kind, inside] += n
    odds = {kind: math.log((each[kind, True] + 0.5) / (total[True] + 1.0))
            - math.log((each[kind, False] + 0.5) / (total[False] + 1.0))
            for kind in {k for k, _ in each} | {WORD, CHROME_WORD, "other"}}
    word = max(odds[WORD], 0.1)
    out = {kind: min(x, -0.05) if kind == LINK else max(min(x, -0.05), -word / 3) for kind, x in odds.items()}
    return out | {WORD: word, CHROME_WORD: -0.05}


def scores(seq: list[tuple[str, str, bool, bool]], w: dict[str, float]) -> list[float]:
    """What each token adds to a region."""
    out = []
    for kind, text, content, chrome in seq:
        n = len(text.split()) if kind == WORD else 1
        if kind == WORD and not chrome:
            out.append(n * w[WORD])
        elif content:
            out.append(n * WITHIN)
        else:
            out.append(n * (w[CHROME_WORD] if chrome else w.get(kind, w["other"])))
    return out


def best_region(values: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the highest positive sum; of equal ones the first to
    end, and of those the shortest. (0, 0) if no value is positive."""
    best, best_at, run, start = 0.0, (0, 0), 0.0, 0
    for k, x in enumerate(values):
        run += x
        if run <= 0:
            run, start = 0.0, k + 1
        elif run > best:
            best, best_at = run, (start, k + 1)
    return best_at


def extract(page: str | None, w: dict[str, float]) -> str:
    """Text blocks of the best region, joined by two line feeds."""
    if not page:
        return ""
    seq = list(tokens(page))
    start, end = best_region(scores(seq, w))
    blocks: list[list[str]] = [[]]
    for kind, text, _, chrome in seq[start:end]:
        if kind == WORD:
            if not chrome:
                blocks[-1].append(_html.unescape(text))
        elif kind in BLOCK:
            blocks.append([])
        elif kind == "br":
            blocks[-1].append(" ")
    texts = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of (page_id, url, html)."""
    counts = saved(count_tokens(pages.select("html")), "html-counts")
    w = weights([(r["kind"], r["inside"], r["n"]) for r in counts.collect()])  # one row per kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [extract(p.as_py(), w) for p in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def q_html_region(spark, sf_dir):
    return extract_pages(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
