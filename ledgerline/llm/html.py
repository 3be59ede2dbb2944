"""Main-text extraction from web pages by consensus of each host's pages.

First pass: every page's containers are scored by the text they hold, less what sits in links, and the best one's path of
tags and classes, with digits taken out, is the page's vote, weighted by its score. Spark sums the votes by host and path
(partial sums first, so a large host is no hot spot) and keeps each host's winner. Second pass: a page is read again with
its host's winning path; where that path is not on the page, the page's own best container is used.
"""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import join_sized

#: Elements that never hold article text, that may hold it by where they stand, that end a block, that have no end
#: tag, and that hold raw text.
NOISE = {"nav", "aside", "script", "style", "noscript", "template", "iframe", "object", "embed", "svg", "canvas", "button", "select", "option", "textarea", "input", "dialog", "menu", "head", "title", "audio", "video", "map"}
BY_PLACE = {"header", "footer", "form", "label", "fieldset"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template", "svg"}
CONTAINER = {"article", "main", "section", "div", "body", "td", "center"}
CLOSES_P = BLOCK
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Characters of a paragraph (blanks not counted) that make an article's own footer part of it.
CLOSING = 80
#: Words in class, id or role that mark menus, headers, footers, sidebars, notices, adverts, forms, comments.
NOISE_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense adsbygoogle banner banners sponsor sponsored promo promos promotion promoted "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager toc header masthead topbar toolbar footer foot bottombar colophon copyright "
    "sidebar sidebars aside rail widget widgets related recommended recommendations trending popular notice notices notification alert cookie cookies consent gdpr disclaimer popup modal overlay "
    "newsletter subscribe subscription signup login form search searchbox share sharing social follow comment comments commentlist disqus respond reply replies discussion complementary contentinfo search".split()
)
#: Words that a noise name may have beside its noise words, and noise names that stay noise however much they hold.
PLACE_WORDS = set("site main left right top bottom global primary secondary box block bar container wrapper wrap area section list item items inner link links icon icons post posts entry body".split())
TALK_WORDS = set("comment comments commentlist disqus respond reply replies discussion".split())
TAG = re.compile(r"<(?:!--.*?(?:-->|$)|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)|[!?][^>]*(?:>|$)|(?P<end>/)?(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|$))", re.S)
ATTR = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
PART = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"\d+")
#: A root of the path that stands for a page whose article has no container of its own.
PAGE = "page"


class Node:
    __slots__ = ("tag", "path", "noise", "parent", "text", "linked", "paragraphs", "commas", "sure", "named", "plain", "full", "chain", "direct", "listed", "heading", "longest")

    def __init__(self, tag: str, path: str, noise: bool, parent: Node | None, sure: bool, named: int = 0):
        self.tag, self.path, self.noise, self.parent, self.sure, self.named = tag, path, noise, parent, sure, named
        self.plain = self.full = self.chain = self.direct = self.listed = 0
        self.text = self.linked = self.paragraphs = self.commas = self.longest = 0
        self.heading = tag in HEADINGS


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in ATTR.finditer(raw)} if "=" in raw else {}


def _noisy(tag: str, attrs: dict[str, str]) -> bool:
    if tag in NOISE:
        return True
    if tag in ("html", "body", "article", "main") or not attrs:
        return "hidden" in attrs
    return attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower()


def _named(attrs: dict[str, str]) -> int:
    """1 if a whole name in class, id or role is made of noise words, 2 if of words for comments, else 0."""
    found = 0
    for name in " ".join(attrs.get(k, "") for k in ("class", "id", "role")).split() if attrs else ():
        words = {w.lower() for w in PART.findall(CAMEL.sub(" ", name))}
        if not NOISE_WORDS.isdisjoint(words) and words <= NOISE_WORDS | PLACE_WORDS:
            found = max(found, 1 if TALK_WORDS.isdisjoint(words) else 2)
    return found


def _general(tag: str, attrs: dict[str, str]) -> str:
    """One step of a path: the tag and its classes (or id), sorted, with digits taken out."""
    names = sorted({DIGITS.sub("#", c.lower()) for c in (attrs.get("class") or attrs.get("id") or "").split()})
    return ".".join([tag, *names]).replace("/", "_")


def read(html: str):
    """Events of a page in order: ('open'|'close', node, None), ('text', node, text), ('break', node, None).

    Missing and stray end tags are taken as browsers take them: a block ends an open paragraph, an end tag closes what was
    left open inside its element, one without its element is passed over, the end of the page closes everything.
    """
    root = Node(PAGE, PAGE, False, None, False)
    stack, at = [root], 0
    yield "open", root, None
    for m in iter(lambda: TAG.search(html, at), None):
        if m.start() > at:
            yield "text", stack[-1], html[at : m.start()]
        at = m.end()
        name = m["name"]
        if m["cdata"] is not None:
            yield "text", stack[-1], m["cdata"]
        if not name:
            if m.end() == m.start():
                at += 1
            continue
        name = name.lower()
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), 0)
            if not depth:
                continue
            for node in reversed(stack[depth:]):
                yield "close", node, None
            del stack[depth:]
            continue
        if name == "br":
            yield "text", stack[-1], " "
            continue
        attrs = _attributes(m["attrs"])
        if "hidden" in m["attrs"] and re.search(r"(?:^|\s)hidden(?:\s|$|=)", m["attrs"]):
            attrs["hidden"] = ""
        until = 0
        if name in CLOSES_P:
            until = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag in CONTAINER or stack[i].tag in NOISE or stack[i].tag in BY_PLACE), 0)
            until = until if until and stack[until].tag == "p" else 0
        if name in ("li", "dt", "dd", "td", "th", "tr", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}.get(name, (name,))
            stop = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}.get(name, ("table",) if name == "tr" else ("tr", "table"))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in stop:
                    break
                if stack[i].tag in same:
                    until = i
                    break
        if until:
            for node in reversed(stack[until:]):
                yield "close", node, None
            del stack[until:]
        parent = stack[-1]
        node = Node(name, f"{parent.path}/{_general(name, attrs)}" if name in CONTAINER or name == "html" else parent.path, parent.noise or _noisy(name, attrs), parent, name in ("article", "main") or attrs.get("role") == "main" or attrs.get("itemprop") == "articleBody", 0 if name in ("html", "body") else _named(attrs))
        if name in VOID or m["attrs"].rstrip().endswith("/") and name not in BLOCK:
            if name == "hr":
                yield "break", parent, None
            continue
        yield "open", node, None
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|$)", re.I).search(html, at)
            at = end.end() if end else len(html)
            yield "close", node, None
            continue
        stack.append(node)
    if at < len(html):
        yield "text", stack[-1], html[at:]
    for node in reversed(stack):
        yield "close", node, None


def _own_part(node: Node, holds: set, total: int) -> bool:
    """Whether a header, footer or form is part of the article: what holds the largest article or main; an article's own header
    with a heading, or its own footer with a long paragraph; a form (or fieldset, label) with a heading or a paragraph that
    holds more than half of the page's text outside links."""
    if id(node) in holds:
        return True
    if node.tag not in ("header", "footer"):
        return (node.heading or node.longest > 0) and 2 * node.plain > total
    up = node.parent
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    return up is not None and not node.named and (node.heading if node.tag == "header" else node.longest >= CLOSING)


def settled(html: str | None) -> list:
    """Events of a page, with noise decided. A noise name does not count on what holds the page's largest article or main,
    on that itself, or, but for comments, on what holds more than half of the text outside links. Headers, footers and forms
    are noise unless they are part of the article."""
    events, links, largest = list(read(html or "")), 0, None
    for kind, node, text in events:
        if kind == "open":
            links += node.tag == "a"
        elif kind == "close":
            links -= node.tag == "a"
            if node.tag == "p":
                node.longest = max(node.longest, node.plain)
            if node.parent is not None:
                node.parent.plain += node.plain
                node.parent.heading |= node.heading
                node.parent.longest = max(node.parent.longest, node.longest)
            if node.sure and not node.noise and node.named < 2 and (largest is None or node.plain > largest.plain):
                largest = node
        elif kind == "text" and not links and not node.noise:
            node.plain += len(text) - text.count(" ") if text.strip() else 0
    root, holds = events[0][1], set()
    while largest is not None:
        holds.add(id(largest))
        largest = largest.parent
    whole = root.plain
    for kind, node, _ in events:
        if kind == "open" and node.parent is not None and not node.noise:
            node.noise = node.parent.noise
            if not node.noise and node.tag in BY_PLACE and not _own_part(node, holds, whole):
                node.noise, up = True, node.parent
                while up is not None:
                    up.plain -= node.plain
                    up = up.parent
    for kind, node, _ in events:
        if kind == "open" and node.parent is not None and not node.noise:
            by_name = node.named and node.tag not in ("article", "main") and id(node) not in holds and (node.named == 2 or 2 * node.plain <= root.plain)
            node.noise = node.parent.noise or bool(by_name)
    return events


def _climbed(node: Node) -> Node:
    """The outermost container reached while the next one adds text outside noise, most of it outside links; body and page
    add only what is in no other container."""
    while not node.sure:
        up = node.parent
        while up is not None and up.tag not in CONTAINER and up.tag != PAGE:
            up = up.parent
        if up is None:
            break
        whole = up.tag not in ("body", PAGE)
        added, linked = (up.full - node.full, up.chain - node.chain) if whole else (up.direct, up.listed)
        if added <= 2 * linked:
            break
        node = up
    return node


def best_container(html: str | None) -> tuple[str, float] | None:
    """The path of the container that holds most of the page's own text, with the blocks beside it, and its score."""
    best, links = None, 0
    for kind, node, text in settled(html):
        if kind == "text":
            if not node.noise:
                n = len(text) - text.count(" ") if text.strip() else 0
                node.text += n
                node.commas += text.count(",") + text.count(".")
                node.full += n
                home = node
                while home.parent is not None and home.tag not in CONTAINER:
                    home = home.parent
                home.direct += n
                if links:
                    node.linked += n
                    node.chain += n
                    home.listed += n
        elif kind == "open":
            links += node.tag == "a"
        elif kind == "close":
            links -= node.tag == "a"
            if node.tag in ("p", "pre", "blockquote", "li") and node.text > 20:
                node.paragraphs += 1
            if node.tag in CONTAINER and not node.noise and node.text:
                own = (node.text - 1.5 * node.linked + 10 * node.paragraphs + 3 * node.commas) * (4.0 if node.sure else 1.0) * (0.5 if node.tag == "body" else 1.0)
                if own > 0 and (best is None or own > best[1]):
                    best = (node, own)
                # an outer container must hold clearly more than an inner one to be chosen instead
                keep = 0.9
            else:
                keep = 1.0
            if node.parent is not None:
                node.parent.full += node.full
                node.parent.chain += node.chain
                node.parent.text += int(node.text * keep)
                node.parent.linked += node.linked
                node.parent.paragraphs += int(node.paragraphs * keep)
                node.parent.commas += int(node.commas * keep)
    return (_climbed(best[0]).path, best[1]) if best else None


def text_at(html: str | None, path: str | None) -> str | None:
    """Text of the containers at a path, blocks joined by newlines; None if the page has none."""
    inside, found, blocks, held = 0, False, [], []

    def close_block():
        if held:
            words = unescape("".join(held)).split()
            if words:
                blocks.append(" ".join(words))
            held.clear()

    for kind, node, text in settled(html):
        if kind == "open":
            if node.path == path and (node.tag in CONTAINER or node.tag == PAGE) and not node.noise and not inside:
                inside, found = id(node), True
                held.clear()
                own = node
            elif inside and (node.tag in BLOCK):
                close_block()
        elif kind == "close":
            if inside and (node.tag in BLOCK or node is own):
                close_block()
            if inside and node is own:
                inside = 0
        elif kind == "break":
            if inside:
                close_block()
        elif inside and not node.noise:
            held.append(text)
    return "\n".join(blocks) if found else None


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", most_broadcast: int = 100_000) -> DataFrame:
    """pages -> all its columns, `path` (the container used) and `text`.

    A null or empty page, or one without text of its own, gives an empty text. A null url votes with the other pages
    without a host. Ties between paths go to the first by name. Repeated rows stay and vote as often as they are given.
    Character references are decoded, white space within a block is one space, blocks are joined by one newline. No rows:
    none. Columns named path, text, _host or _winner are replaced.
    """
    names = [c for c in pages.columns if c not in ("path", "text", "_host", "_winner")]

    def vote(batches):
        for pdf in batches:
            rows = [(host_of(u), *b) for u, h in zip(pdf["url"], pdf["html"], strict=True) if (b := best_container(h))]
            yield pd.DataFrame(rows, columns=["_host", "path", "score"]).groupby(["_host", "path"], as_index=False)["score"].sum()

    votes = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInPandas(vote, "_host string, path string, score double")
    summed = votes.groupBy("_host", "path").agg(F.round(F.sum("score"), 3).alias("score"))
    winners = summed.groupBy("_host").agg(F.min(F.struct(-F.col("score"), "path")).alias("w")).select("_host", F.col("w.path").alias("_winner"))

    @F.pandas_udf("path string, text string")
    def again(html: pd.Series, winner: pd.Series) -> pd.DataFrame:
        out = []
        for h, w in zip(html, winner, strict=True):
            path, text = w, text_at(h, w) if isinstance(w, str) else None
            if not text:
                own = best_container(h)
                path, text = (own[0], text_at(h, own[0])) if own else (PAGE, text_at(h, PAGE))
            out.append((path, text or ""))
        return pd.DataFrame(out, columns=["path", "text"])

    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    hosted = join_sized(pages.select(*names, host.alias("_host")), winners, ["_host"], "left", most_broadcast)
    return hosted.select(*names, again(F.col(html_col), F.col("_winner")).alias("_got")).select(*names, "_got.path", "_got.text")


def op3_html(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
