"""Main text of web pages: structural rules and removal of site templates.

Elements that are never article text (menus, page headers and footers, sidebars, forms,
notices, adverts, comments, scripts) are left out by tag, role, class or id. On every page the
subtrees of the other elements are hashed, Spark counts per host on how many pages of different
content each hash occurs, and subtrees that recur across many pages of the host are deleted. Inside
a marked article this takes half of the host's pages, as a box of the site has, because pages may
well share passages, which are content. If a page marks articles, only these are read.
"""

import hashlib
import re
from collections import Counter
from html import unescape

import pandas as pd
from pyspark.sql import functions as F

from .common import salted_join, stage
from .urls import host_and_path

MIN_PAGES = 5  # pages of different content that must share a subtree
MIN_SHARE = 0.1  # of the host's pages of different content
INNER_SHARE = 0.5  # the same for subtrees inside a marked article

# The vocabulary of HTML, and names that mark page furniture.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S
)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr img script style template noscript button".split()
)
SKIP_TAGS = frozenset(
    "head script style textarea title noscript iframe xmp noembed noframes template nav footer aside form"
    " button select option datalist dialog menu svg canvas object audio video map".split()
)
SKIP_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar"
    " tablist status".split()
)
SKIP_NAMES = frozenset(
    "ad ads advert advertisement advertising adsense adbox banner sponsor sponsored promo promotion sidebar"
    " nav navbar navigation menu breadcrumb breadcrumbs footer masthead comment comments disqus respond"
    " reply replies cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup"
    " social share sharing related recommended popup modal overlay pagination pager skip widget login toolbar"
    " disclaimer".split()
)
KEEP = frozenset(("html", "body", "main"))
NOT_ARTICLES = frozenset("ad advert comment comments promo recommended related reply replies sponsored teaser".split())
CLOSES = {  # a start tag of this kind ends open elements of that kind, up to a boundary
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
    "body": ("head",),
}
BOUNDARY = frozenset("ul ol dl table select body html article main section div".split())


def _skipped(tag, attributes, in_article):
    if tag in SKIP_TAGS or (tag == "header" and not in_article):
        return True
    if tag in KEEP or not attributes.strip():
        return False
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or values.get("aria-hidden") == "true" or values.get("role", "").lower() in SKIP_ROLES:
        return True
    if "display:none" in values.get("style", "").replace(" ", "").lower():
        return True
    names = re.split(r"[^a-z0-9]+", f"{values.get('class', '')} {values.get('id', '')}".lower())
    return not (NOT_ARTICLES if tag == "article" else SKIP_NAMES).isdisjoint(names)


def _digest(*parts):
    key = hashlib.blake2b("\x00".join(parts).encode(errors="replace"), digest_size=8)
    return int.from_bytes(key.digest(), "little", signed=True)


def read_page(html, drop=frozenset()):
    """(main text, hashes of the subtrees outside of articles, of those inside) of one page.

    `drop` holds the hashes of the subtrees to delete. The hash of an element covers its tag,
    its attributes, its own text and the hashes of its elements, so every character is hashed
    once however deep the page is.
    """
    pieces, stack, regions = [], [], []
    outer, inner = set(), set()
    blocks = [[0, []]]  # per open block: where its own text goes on, texts and hashes so far
    open_tags = Counter()
    skip = at = inside = 0  # depth of left-out elements, position, depth of marked articles

    def own_text():
        text = " ".join("".join(pieces[blocks[-1][0] :]).split())
        if text:
            blocks[-1][1].append(text)
        blocks[-1][0] = len(pieces)

    def close():
        nonlocal skip, inside
        tag, attributes, start, skipped = stack.pop()
        open_tags[tag] -= 1
        skip -= skipped
        if tag not in INLINE:
            pieces.append(" ")
        if skip or skipped or tag in INLINE:
            return
        own_text()
        parts = blocks.pop()[1]
        if parts:
            value = _digest(tag, attributes.strip(), *parts)
            blocks[-1][1].append(f"\x01{value}")
            if tag not in ("article", "main") and tag not in KEEP:
                (inner if inside else outer).add(value)
                if value in drop:
                    pieces[start:] = [" "]
        blocks[-1][0] = len(pieces)
        if tag in ("article", "main"):
            inside -= 1
            regions.append((tag, start, len(pieces)))

    for m in TOKEN.finditer(html):
        if m.start() < at:
            continue  # inside raw text
        if not skip and m.start() > at:
            pieces.append(unescape(html[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if open_tags[tag]:
                while stack[-1][0] != tag:
                    close()
                close()
            elif tag not in INLINE and not skip:
                pieces.append(" ")
            continue
        if tag not in INLINE and not skip:
            pieces.append(" ")
        if tag in VOID:
            continue
        ends = CLOSES.get(tag, ()) if tag in INLINE or tag in CLOSES else ("p",)
        if tag in ("li", "dt", "dd", "td", "th", "tr"):
            ends = (*ends, "p")
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    while len(stack) > i:
                        close()
                elif stack[i][0] in BOUNDARY:
                    break
        if m[0].endswith("/>") and tag in ("svg", "path"):
            continue
        skipped = _skipped(tag, m[3], inside)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
        if tag not in INLINE and not skip and not skipped:
            own_text()
            blocks.append([len(pieces), []])
        stack.append((tag, m[3], len(pieces), skipped))
        open_tags[tag] += 1
        skip += skipped
        inside += tag in ("article", "main") and not skip
    if not skip and at < len(html):
        pieces.append(unescape(html[at:]))
    while stack:
        close()

    for wanted in ("article", "main"):
        # those that are not inside another of their kind, in page order
        texts, end = [], -1
        for _, low, high in sorted((r for r in regions if r[0] == wanted), key=lambda r: (r[1], -r[2])):
            if high > end:
                texts.append(" ".join("".join(pieces[low:high]).split()))
                end = high
        found = " ".join(t for t in texts if t)
        if found:
            return found, outer, inner
    return " ".join("".join(pieces).split()), outer, inner


def extract_main_text(spark, pages, row_id="page_id", url="url", html="html"):
    """`row_id`, `url`, `text`, `n_chars` per row of `pages`.

    Null and empty html give an empty text; a null url counts as a host of its own. Pages
    are read one at a time and whole. Exact copies count once on their host; rows that
    repeat an id get the deletions of all its rows. Other columns are ignored.
    """
    host, _ = host_and_path(F.col(url))
    slim = pages.select(F.col(row_id).alias("page_id"), F.col(url).alias("url"), host.alias("host"), F.col(html).alias("html"))

    def outline(frames):
        for f in frames:
            read = [read_page(h or "") for h in f["html"]]
            yield pd.DataFrame(
                {
                    "page_id": f["page_id"],
                    "host": f["host"],
                    "content": [hashlib.blake2b(t.encode(errors="replace"), digest_size=12).hexdigest() for t, _, _ in read],
                    "outer": [sorted(o - i) for _, o, i in read],
                    "inner": [sorted(i) for _, _, i in read],
                }
            )

    seen = slim.select("page_id", "host", "html").mapInPandas(
        outline, "page_id bigint, host string, content string, outer array<bigint>, inner array<bigint>"
    )
    seen = stage(spark, seen, "html-subtrees")
    # what stands inside an article on one page counts as inside for the whole host
    marks = F.concat(
        F.transform("outer", lambda h: F.struct(h.alias("hash"), F.lit(False).alias("inner"))),
        F.transform("inner", lambda h: F.struct(h.alias("hash"), F.lit(True).alias("inner"))),
    )
    each = seen.select("page_id", "host", "content", F.explode(marks).alias("m"))
    each = each.select("page_id", "host", "content", "m.hash", "m.inner")
    counts = each.groupBy("host", "hash").agg(F.count_distinct("content").alias("n"), F.max("inner").alias("inner"))
    sizes = seen.groupBy("host").agg(F.count_distinct("content").alias("pages"))
    often = salted_join(counts.filter(F.col("n") >= MIN_PAGES), sizes, ["host"], ["hash"])
    share = F.when(F.col("inner"), INNER_SHARE).otherwise(MIN_SHARE)
    often = often.filter(F.col("n") >= F.col("pages") * share).select("host", "hash", F.lit(True).alias("hit"))
    often = stage(spark, often, "html-templates")
    drops = (
        salted_join(each.select("page_id", "host", "hash"), often, ["host", "hash"], ["page_id"])
        .filter("hit")
        .groupBy("page_id")
        .agg(F.collect_set("hash").alias("drop"))
    )
    drops = stage(spark, drops, "html-drops")

    def extract(frames):
        for f in frames:
            text = [
                read_page(h, frozenset(d) if d is not None else frozenset())[0] if h else ""
                for h, d in zip(f["html"], f["drop"])
            ]
            yield pd.DataFrame({"page_id": f["page_id"], "url": f["url"], "text": text})

    both = slim.select("page_id", "url", "html").join(drops, "page_id", "left")
    done = both.mapInPandas(extract, "page_id bigint, url string, text string")
    return done.select(F.col("page_id").alias(row_id), F.col("url").alias(url), "text", F.length("text").cast("bigint").alias("n_chars"))
