"""Operator 2: main text of web pages from flat text blocks.

A page is cut into flat blocks of text at block-level tags. Each block has statistics of
its own and of its neighbours: words, share of words in links, and whether the open elements
around it are an article, page furniture (menus, headers, footers, asides, adverts, forms,
comments) or neither. A decision tree over them, fitted on the small labelled table of
``LABELLED``, says which blocks are main text. Neighbours lie in the same page, so a page
is classified in one piece; pages are spread as Spark reads them.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after", "article", "furniture", "heading", "sentence"]
DEPTH = 6

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?<=/)>"  # empty
    r"|<(?P<raw>script|style|noscript|textarea|iframe|title)(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<closed>template|select|object|svg|canvas|button|audio|video|math)(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?</(?P=closed)\s*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)",
    re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Words of a class that tell what a page's layout has, not what the element is.
_LAYOUT = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no|is|hide|show)[_-]\S*", re.I)
_LINK = re.compile(r"<(/?)a(?=[\s/>])", re.I)
#: Elements that flow inside a block.
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that hold blocks and close by name.
_HOLDERS = set("html body div section article main nav header footer aside form ul ol dl table tbody thead tfoot tr td th figure figcaption blockquote details fieldset menu dialog center p li".split())
_FURNITURE = set("nav footer aside menu dialog".split())
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_NAMED_FURNITURE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adv|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|header|masthead|topbar|foot|footer|sidebar|side|widget\w*|aside|related|recommend\w*"
    r"|comment\w*|reply|replies|disqus\w*|respond|share|sharing|social\w*|cookie\w*|consent|notice\w*|notification\w*|alert|popup|modal|newsletter|subscribe|signup|login|search\w*|form|toc|pagination|pager|tags|meta|byline|copyright|legal|disclaimer|skip)(?=$|[\s_-])", re.I)
_NAMED_ARTICLE = re.compile(r"(?:^|[\s_-])(?:article\w*|content|main|post|entry|story|body|text)(?=$|[\s_-])", re.I)
_ROLES = {"navigation": "f", "banner": "f", "contentinfo": "f", "complementary": "f", "search": "f", "form": "f", "alert": "f", "dialog": "f", "menu": "f",
          "main": "a", "article": "a"}


def _kind(tag: str, attrs: str, inside_article: bool) -> str:
    """'f' for page furniture, 'w' for a form, which is furniture unless an article lies nearer, 'a' for an article, '' for neither."""
    got = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip() else {}
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", got.get("style", ""), re.I):
        return "f"
    if tag in _FURNITURE or (tag == "header" and not inside_article):
        return "f"
    role = _ROLES.get(got.get("role", "").lower(), "")
    if role:
        return role
    if tag == "form":
        return "w"
    if tag in ("article", "main"):
        return "f" if re.search(r"comment|reply|replies", f"{got.get('class', '')} {got.get('id', '')}", re.I) else "a"
    names = _LAYOUT.sub("", f"{got.get('class', '')} {got.get('id', '')}")
    if names.strip() and tag not in ("html", "body"):
        if _NAMED_FURNITURE.search(names):
            return "f"
        if _NAMED_ARTICLE.search(names):
            return "a"
    return ""


def blocks(page: str) -> list[tuple[str, dict]]:
    """(text, own statistics) of the blocks of a page, in page order; text has references decoded and white space joined."""
    out, parts = [], []
    stack: list[tuple[str, str]] = []  # open holders and their kind
    state = {"link": 0, "heading": False}  # link: where the open link ends
    linked: list[str] = []
    open_link = False

    def flush():
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            words = len(text.split())
            kinds = [k for _, k in stack]
            near = next((k for k in reversed(kinds) if k), "")
            in_links = len(" ".join(entities.unescape("".join(linked)).split()).split())
            out.append((text, {"words": words, "links": min(1.0, in_links / words), "article": int("a" in kinds), "furniture": int("f" in kinds or near == "w"),
                               "heading": int(state["heading"]), "sentence": int(text[-1] in ".!?:;\"'»”…)")}))
        parts.clear()
        linked.clear()

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            parts.append(page[at : m.start()])
            if m.start() <= state["link"]:
                linked.append(page[at : m.start()])
                linked.append(" ")
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        end = bool(m["end"] or m["end2"])
        if tag == "a":  # a link goes on through blocks up to its end, where it has one before the next begins
            nxt = None if end else _LINK.search(page, at)
            state["link"] = nxt.start() if nxt and nxt[1] else 0 if end else -1
            if state["link"] < 0:
                state["link"] = len(page)
                open_link = True
            else:
                open_link = False
        if tag in _INLINE:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        flush()
        if open_link:  # without an end: up to the end of its block
            state["link"], open_link = 0, False
        if tag in _HEADINGS:
            state["heading"] = not end
        if tag in _HOLDERS:
            if end:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            else:
                if tag in ("p", "li"):  # an open paragraph ends where the next begins
                    for k in range(len(stack) - 1, -1, -1):
                        if stack[k][0] == tag:
                            del stack[k:]
                            break
                        if stack[k][0] not in ("p", "li"):
                            break
                attrs = m["attrs"] or ""
                stack.append((tag, _kind(tag, attrs, any(k == "a" for _, k in stack))))
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def features(own: list[dict]) -> list[list[float]]:
    """FEATURES of each block of a page; beyond an end of the page lie blocks of no words and no links."""
    none = {"words": 0, "links": 0.0}
    out = []
    for i, b in enumerate(own):
        p, n = own[i - 1] if i else none, own[i + 1] if i + 1 < len(own) else none
        out.append([float(x) for x in (b["words"], b["links"], p["words"], p["links"], n["words"], n["links"], b["article"], b["furniture"], b["heading"], b["sentence"])])
    return out


def labelled() -> list[tuple[list[float], float]]:
    """The training table: (features, 1 for main text) of the blocks of LABELLED."""
    rows = []
    for page, keep in LABELLED:
        got = blocks(page)
        if len(got) != len(keep):
            raise ValueError(f"{len(keep)} labels for {len(got)} blocks: {[t for t, _ in got]}")
        rows += zip(features([b for _, b in got]), map(float, keep))
    return rows


def fit(spark: SparkSession) -> list:
    """Decision tree of the labelled table as nested [feature, bound, left (<=), right] or a leaf 0.0 / 1.0."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.linalg import Vectors

    rows = spark.createDataFrame([(Vectors.dense(x), y) for x, y in labelled()], ["x", "y"]).coalesce(1)
    model = DecisionTreeClassifier(featuresCol="x", labelCol="y", maxDepth=DEPTH, maxBins=64, minInstancesPerNode=1, seed=1).fit(rows)
    lines = [x.strip() for x in model.toDebugString.splitlines()[1:] if x.strip()]

    def read():
        m = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[0])
        if not m:
            return float(re.match(r"Predict: (\S+)", lines.pop(0))[1])
        lines.pop(0)
        left = read()
        lines.pop(0)  # Else
        return [int(m[1]), float(m[2]), left, read()]

    return read()


def _says(tree, x) -> bool:
    while isinstance(tree, list):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree > 0.5


def main_text(page: str | None, tree) -> tuple[str, int, int]:
    """(text, blocks, blocks kept) of a page."""
    got = blocks(page or "")
    keep = [t for (t, _), x in zip(got, features([b for _, b in got]), strict=True) if _says(tree, x)]
    return " ".join(keep), len(got), len(keep)


def extract(pages: DataFrame) -> DataFrame:
    """One row (page_id, url, text, n_chars, n_blocks, n_kept) per row of ``pages`` (page_id, url, html; others are ignored).

    A null or empty page, or one without main text, has an empty text. Rows repeat as they come, null ids and urls
    stay null. An empty table gives no rows.
    """
    spark = pages.sparkSession
    tree = fit(spark)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.large_string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64()), ("n_kept", pa.int64())])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                got = [main_text(p, tree) for p in part.column(2).to_pylist()]
                yield pa.record_batch([part.column(0), part.column(1).cast(pa.string()), pa.array([g[0] for g in got], pa.large_string()), pa.array([len(g[0]) for g in got], pa.int64()),
                                       pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64())], schema=schema)

    rows = c.columns_of(pages, {"page_id": "long", "url": "string", "html": "string"})
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")


def op2_html_extraction(spark, sf_dir):
    return extract(c.read_table(spark, sf_dir, "pages"))


_LONG = "The committee met on Tuesday to discuss the plan for the new bridge, and after two hours it agreed to ask for more money."
_MORE = "Engineers say that the old crossing can carry traffic for ten more years if the joints are replaced before winter sets in."
_MID = "Nobody voted against it in the end."

#: Small labelled pages: for each block of the page, in order, 1 if it is main text.
LABELLED = [
    (f"<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav><article><h1>Bridge plan</h1><p>{_LONG}</p><p>Yes.</p><p>{_MORE}</p></article><footer>Copyright 2020 The Paper</footer>",
     [0, 0, 1, 1, 1, 1, 0]),
    (f"<div class=ad>Buy two and get a third one free in our shops until Sunday.</div><article><h1>Vote</h1><p><b>{_MID}<br><p>{_LONG}</article><footer>&copy; paper.example &middot; {_MID}</footer>",
     [0, 1, 1, 1, 0]),
    (f"<header>The Daily Paper, founded 1890, read by all who care for the news of the town</header><main><h2>Roads</h2><p>{_MORE}</p><ul><li>joints</li><li>deck</li></ul></main><aside><p>{_LONG}</p></aside>",
     [0, 1, 1, 1, 1, 0]),
    (f"<div id=menu><a href=a>One</a> <a href=b>Two</a></div><div><h1>Title of it</h1><p>{_LONG}</p><p>{_MID}</p><p>{_MORE}</p></div><div class='footer'>All rights reserved by the owner of this page.</div>",
     [0, 1, 1, 1, 1, 0]),
    (f"<table><tr><td><a href=1>Sports today</a></td><td><a href=2>Weather report</a></td></tr></table><p>{_LONG}</p><p>{_MORE}</p><p><a href=3>More of this</a></p><p>Terms</p>",
     [0, 0, 1, 1, 0, 0]),
    (f"<article><header><h1>On bridges</h1></header><p>{_LONG}</p><div class='share'>Share this on your page</div><p>{_MORE}</p><blockquote>{_MID}</blockquote></article><section class=comments><p>{_LONG}</p><p>I disagree.</p></section>",
     [1, 1, 0, 1, 1, 0, 0]),
    (f"<div class=cookie-notice>We use cookies to make this page work better for you and for all of our partners.</div><div class=content><p>{_MID}</p><p>{_LONG}</p></div><form><p>Sign up for our letter and hear from us every week.</p></form>",
     [0, 1, 1, 0]),
    (f"<p>{_LONG}</p><p>{_MORE} <a href=x>As we wrote</a> before.</p><p>{_MID}</p><p>{_LONG}</p><div><a href=1>Older</a> <a href=2>Newer</a></div>",
     [1, 1, 1, 1, 0]),
    (f"<div><a href=1>Log in</a></div><div>Search</div><h1>A walk by the river</h1><div>{_LONG}</div><div>{_MORE}</div><div>Tags: <a href=1>river</a> <a href=2>walk</a></div><div>Contact</div>",
     [0, 0, 1, 1, 1, 0, 0]),
    (f"<body><ul><li><a href=1>Start</a></li><li><a href=2>About us</a></li><li><a href=3>Contact us</a></li></ul><h2>Opening</h2><p>{_MORE}</p><p>{_LONG}</p><div>Print</div>",
     [0, 0, 0, 1, 1, 1, 0]),
    (f"<main><p>{_MID}</p><p><a href=1>Read the report</a></p><h3>Why</h3><p>{_LONG}</p></main><div class=sidebar><h3>Popular</h3><p>{_MORE}</p></div><div role=contentinfo>Imprint</div>",
     [1, 1, 1, 1, 0, 0, 0]),
    (f"<div class=post><h1>Short</h1><p>No.</p></div><div id=comments><h3>Two replies</h3><p>{_MORE}</p><p>{_MID}</p></div>", [1, 1, 0, 0, 0]),
    (f"<article><p>Fine.</p></article><nav><a href=1>Next page</a></nav><aside>{_MORE}</aside><footer>{_LONG}</footer>", [1, 0, 0, 0]),
    (f"<article><h1>Only a title</h1></article><div class=promo>{_LONG}</div><div class=newsletter>{_MORE}</div>", [1, 0, 0]),
    # an article may begin or end the page, follow links without a heading, or hold short and linked blocks
    (f"<article><p>{_MID}</p><p>{_LONG}</p><p>End.</p></article>", [1, 1, 1]),
    (f"<nav><a href=1>Home</a></nav><article><p>{_LONG}</p><p>Yes.</p></article>", [0, 1, 1]),
    (f"<nav><a href=1>Home</a><a href=2>Away</a></nav><main><p>Go.</p></main>", [0, 1]),
    (f"<article><p>One.</p><p>Two</p><p>{_MORE}</p><p><a href=1>The list of all the members</a></p><p>Three</p></article>", [1, 1, 1, 1, 1]),
    (f"<div class=article><p><a href=9>Report</a></p><p>{_MID}</p><ul><li>a</li><li><a href=3>b</a></li></ul></div>", [1, 1, 1, 1]),
    (f"<article><h1>Lines</h1><p>x</p><p>y</p><p>z</p></article><footer>{_MID}</footer>", [1, 1, 1, 1, 0]),
    (f"<article><h1><a href=1>Linked title of this story</a></h1><p>{_MID}</p><div class=ad><p>{_LONG}</p></div><p>Last</p></article>", [1, 1, 0, 1]),
    (f"<article><p>{_LONG}</p><aside><p>{_MORE}</p></aside><p>{_MID}</p><form><p>Mail</p></form></article>", [1, 0, 1, 0]),
    # without any marking, a page's own long blocks and what stands between them
    (f"<p>{_LONG}</p><p>{_MORE}</p>", [1, 1]),
    (f"<div><a href=1>Home</a> <a href=2>News</a></div><p>{_MORE}</p><p>{_LONG}</p>", [0, 1, 1]),
    (f"<div><a href=1>Home</a></div><h1>Title</h1><p>{_MORE}</p>", [0, 1, 1]),
    (f"<p>{_LONG}</p><p>{_MID}</p><p>{_MORE}</p><div>Print</div><div><a href=2>Next</a></div><div>Help</div>", [1, 1, 1, 0, 0, 0]),
    (f"<div>Menu</div><div><a href=2>Start</a></div><div>Login</div><p>{_LONG}</p>", [0, 0, 0, 1]),
]
