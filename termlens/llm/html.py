"""Main text of web pages: marked regions, and a site style tree for what carries no mark.

A page is read into blocks: the text between two block-level tags, with the
path of open elements (tag and normalised class) above it.  Marks decide first:
``article`` and ``main`` hold content; menus, headers, footers, asides, forms,
scripts and elements whose class, id or role names an advert, a notice, a
sidebar or reader comments do not, wherever they stand.  On a page with an
article only the article's unmarked rest is kept.

What the marks leave, inside articles too, is judged by the site's style tree:
the blocks of all pages of a host are merged by path.  A path that m pages
share has

* content importance: 1 minus the mean entropy (base m) of its words over the
  pages; words spread evenly over all pages say nothing about any one,
* presentation importance: the entropy (base m) of the inline styles that its
  blocks have, though not less than its content importance,

combined as (1 - g ** l) * content + g ** l * presentation for l inline styles
(g = 0.9).  Inside an article or main the equal blocks of a path are leaves of
their own from three words on (a table repeats single ones), since a notice may
be a paragraph like the others; a leaf on n of the m pages, more than half of them,
has importance 1 - log(n) / log(m); one on fewer is text that pages share.  There the mark
counts as ``prior`` pages of importance 1.  Branches under ``least`` are removed
from every page of the host, with two exceptions inside articles: a path that
holds more than half of a page's marked text is its body, and a page that would
lose more than half of that text is a copy of others and stays whole.  A path
seen on one page only stays.  The tree is built by grouped sums on (host, path,
word or leaf), so a host with a third of all pages is many partial sums.

Marks come first because menus and adverts may differ on every page; entropy
alone would keep them.  Defined results: null or empty html gives an empty
text; white space (also no-break spaces) in a block becomes one space; broken
markup closes what it must; a page without url is a site of its own; repeated
rows are pages of their own; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import emit, rows_of, written

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMES = re.compile(r"""(?:^|[\s"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_RAW = ("script", "style", "textarea", "title", "iframe", "noframes", "xmp")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre search section select
summary table tbody td template tfoot th thead tr ul""".split())
_NOISE = frozenset("nav header footer aside form button select menu dialog head noscript template svg script style iframe title textarea option fieldset".split())
_CONTENT = frozenset(("article", "main"))
_NOISE_NAMES = frozenset("""ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline captcha comment comments complementary
consent contentinfo cookie cookies dialog disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice
notification overlay pagination paywall popup promo promotion related replies reply respond search share sharing sidebar signup skip social sponsor
sponsored subscribe subscription toc toolbar tooltip topbar widget""".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset(("ul", "ol", "dl", "table", "article", "main", "body", "div", "section"))
_DIGITS = re.compile(r"\d+")
KEEP, NOISE, OPEN = 1, 0, -1


def _names(attrs: str) -> list[str]:
    return [w for _, a, b, c in _NAMES.findall(attrs) for w in re.split(r"[^a-z]+", (a or b or c).lower()) if w]


class _Node:
    __slots__ = ("tag", "mark", "path", "named")

    def __init__(self, tag, mark, path, named):
        self.tag, self.mark, self.path, self.named = tag, mark, path, named


def blocks(html: str | None) -> tuple[list[tuple[str, int, int, str]], bool]:
    """([(text, mark, path hash, inline styles)], whether the page has an article), in page order."""
    out: list[tuple[str, int, int, str]] = []
    html = html or ""
    stack = [_Node("", OPEN, 0, False)]
    buf: list[str] = []
    styles: list[str] = []
    article = False

    def flush():
        if buf:
            text = " ".join("".join(buf).split())
            if text:
                top = stack[-1]
                out.append((text, top.mark, top.path, " ".join(styles)))
            buf.clear()
        styles.clear()

    def pop_to(k):
        flush()
        del stack[k:]

    at = 0
    while at < len(html):
        lt = html.find("<", at)
        if lt < 0:
            buf.append(unescape(html[at:]))
            break
        if lt > at:
            buf.append(unescape(html[at:lt]))
        m = _TOKEN.match(html, lt)
        if not m:  # a sign, not a tag; an unfinished tag at the end is dropped
            if re.match(r"</?[a-zA-Z]", html[lt:lt + 3]):
                break
            buf.append("<")
            at = lt + 1
            continue
        at = m.end()
        if m[2] is None and m[5] is None:
            continue
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] is not None else (m[4], m[5], m[6])
        tag = tag.lower()
        if close:
            if tag in _BLOCK or any(n.tag == tag for n in stack[-6:]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        if tag in _BLOCK or tag in _NOISE or stack[k].named:
                            pop_to(k)
                        else:
                            del stack[k:]
                        break
                    if tag not in _BLOCK and stack[k].tag in _BLOCK:
                        break
                else:
                    if tag in _BLOCK:
                        flush()
            continue
        if tag in _RAW:
            end = re.compile(f"</{tag}", re.I).search(html, at)
            at = end.start() if end else len(html)
            gt = html.find(">", at)
            at = gt + 1 if gt >= 0 else len(html)
            continue
        if tag == "br":
            buf.append(" ")
            continue
        block = tag in _BLOCK
        if block:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # a paragraph ends where a block begins
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in _BLOCK:
                    break
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _CLOSES.get(tag, ()):
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE:
                    break
        if tag in _VOID:
            continue
        names = _names(attrs) if attrs else []
        top = stack[-1]
        if tag in _CONTENT and top.mark == NOISE and not article:  # a menu or header that was never closed
            while len(stack) > 1 and stack[-1].mark == NOISE:
                stack.pop()
            top = stack[-1]
        content = tag in _CONTENT or "main" in names and "role" in attrs.lower()
        noisy = tag in _NOISE and not (tag == "header" and top.mark == KEEP) or any(n in _NOISE_NAMES for n in names)
        if tag in ("html", "body") or content and top.mark == OPEN:
            noisy = False
        mark = NOISE if top.mark == NOISE or noisy else KEEP if content or top.mark == KEEP else OPEN
        if mark == KEEP:
            article = True
        if block or noisy:
            if noisy and not block:
                flush()
            path = xxhash.xxh3_64_intdigest(f"{top.path}>{tag}.{' '.join(sorted(set(names)))}") >> 1
            stack.append(_Node(tag, mark, path, noisy))
        else:
            styles.append(tag)
            stack.append(_Node(tag, mark, top.path, False))
        if len(stack) > 2000:  # deeper markup is kept flat: its text belongs to the same branch
            stack.pop()
    flush()
    return out, article


def _host():
    return F.lower(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


WORD_SHIFT = 16  # the tree tells words apart by 48 bits of their hashes: they go into mean entropies only


def _leaf(path: int, text: str) -> int:
    """The leaf of a marked block: its path and its text."""
    return xxhash.xxh3_64_intdigest(f"{path}>{text}") >> 1


def style_tree(pages: DataFrame, g: float = 0.9, prior: float = 2.0) -> DataFrame:
    """``pages(site, html)`` -> (site, branch, importance) of the paths without a noise mark and of the repeated leaves of marked ones."""
    schema = pa.schema([("site", pa.int64()), ("path", pa.int64()), ("kind", pa.int32()), ("item", pa.int64()), ("n", pa.float64()),
                        ("nlogn", pa.float64()), ("l", pa.int64()), ("keep", pa.int32())])

    def run(batches):
        def rows():
            for site, html in rows_of(batches, "site", "html"):
                by: dict[int, Counter] = {}
                style: dict[int, str] = {}
                marked: dict[int, set[int]] = {}
                for text, mark, path, styles in blocks(html)[0]:
                    if mark != NOISE:
                        by.setdefault(path, Counter()).update(text.split())
                        style[path] = style.get(path, "") + "/" + styles
                    if mark == KEEP:
                        marked.setdefault(path, set()).update([_leaf(path, text)] if text.count(" ") > 1 else [])
                for path, words in by.items():
                    for w, n in words.items():
                        yield site, path, 0, xxhash.xxh3_64_intdigest(w) >> WORD_SHIFT, float(n), n * math.log(n), 0, 0
                    yield site, path, 1, xxhash.xxh3_64_intdigest(style[path]) >> 1, 1.0, 0.0, 1 + style[path].count(" "), int(path in marked)
                    for leaf in marked.get(path, ()):
                        yield site, path, 2, leaf, 1.0, 0.0, 0, 1

        yield from emit(rows(), schema, 8192)

    items = pages.select("site", "html").where("html is not null").mapInArrow(
        run, "site bigint, path bigint, kind int, item bigint, n double, nlogn double, l bigint, keep int")
    sums = items.groupBy("site", "path", "kind", "item").agg(F.sum("n").alias("n"), F.sum("nlogn").alias("nlogn"), F.max("l").alias("l"), F.max("keep").alias("keep"))
    # of a word: entropy over pages; of a style: its part of the entropy over styles; a leaf's sum is its number of pages
    kind = [F.col("kind") == k for k in range(3)]
    second = sums.where("kind < 2 or n > 1").groupBy("site", "path", F.when(kind[2], F.col("item")).alias("leaf")).agg(
        F.avg(F.when(kind[0], F.log("n") - F.col("nlogn") / F.col("n"))).alias("words"),
        F.sum(F.when(kind[1], F.col("n"))).alias("n_pages"),
        F.sum(F.when(kind[1], F.col("n") * F.log("n"))).alias("styles"),
        F.max(F.when(kind[1], F.col("l"))).alias("l"),
        F.max("keep").alias("keep"), F.sum(F.when(kind[2], F.col("n"))).alias("seen"))
    second = written(second, "style_sums")  # a row for each path and each repeated leaf
    paths = second.where("leaf is null and n_pages > 1").drop("leaf", "seen")
    base = F.log("n_pages")
    content = 1 - F.coalesce(F.col("words"), F.lit(0.0)) / base
    shown = (base - F.col("styles") / F.col("n_pages")) / base
    weight = F.pow(F.lit(g), F.col("l"))
    both = (1 - weight) * content + weight * F.greatest(shown, content)
    leaves = second.where("leaf is not null").select("site", "path", "leaf", "seen")
    leaves = leaves.join(paths.select("site", "path", "n_pages"), ["site", "path"]).where("2 * seen > n_pages")

    def with_mark(importance):
        return (F.col("n_pages") * importance + prior) / (F.col("n_pages") + prior)

    return paths.select("site", F.col("path").alias("branch"), F.when(F.col("keep") == 1, with_mark(both)).otherwise(both).alias("importance")).unionByName(
        leaves.select("site", F.col("leaf").alias("branch"), with_mark(1 - F.log("seen") / F.log("n_pages")).alias("importance")))


def kept_blocks(html: str | None, gone: set[int]) -> list[str]:
    """The blocks of a page that its marks and its site's tree leave."""
    found, article = blocks(html)
    if not article:
        return [t for t, mark, path, _ in found if mark == OPEN and path not in gone]
    texts = [(t, path) for t, mark, path, _ in found if mark == KEEP]
    if not gone:
        return [t for t, _ in texts]
    size = Counter()
    for t, path in texts:
        size[path] += len(t)
    whole = sum(size.values())
    left = [t for t, path in texts if (path not in gone or 2 * size[path] > whole) and _leaf(path, t) not in gone]
    return left if 2 * sum(map(len, left)) >= whole else [t for t, _ in texts]


def extract(pages: DataFrame, least: float = 0.2) -> DataFrame:
    """``pages(page_id, url, html)`` -> (page_id, url, text)."""
    # a page without a host is a site of its own; its branches are seen once and stay
    sited = pages.select(F.col("page_id").cast("bigint"), "url", "html", F.when(F.length(_host()) > 0, F.xxhash64(_host())).alias("site"))
    tree = written(style_tree(sited.where("site is not null")).where(F.col("importance") < least).select("site", "branch"), "style_tree")
    drop = tree.groupBy("site").agg(F.sort_array(F.collect_list("branch")).alias("gone"))  # templates of one site

    def run(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

        def rows():
            for page, url, html, gone in rows_of(batches, "page_id", "url", "html", "gone"):
                yield page, url, "\n".join(kept_blocks(html, set(gone or ())))

        yield from emit(rows(), schema, 1024, lambda r: len(r[2]))

    return sited.join(drop, "site", "left").select("page_id", "url", "html", "gone").mapInArrow(run, "page_id bigint, url string, text string")
