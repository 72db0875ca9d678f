"""Main text and url verdicts of pages."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tallybrook.llm import html, queries, urls
from tallybrook.llm.common import table

MENU = "<div><ul><li>Home</li><li>Shop</li></ul></div>"


def test_structure():
    read = lambda page: html.read_page(page)[0]
    assert read("") == ""
    assert read("plain &lt; text &amp; more") == "plain < text & more"
    assert read("<body><nav>menu</nav><article><h1>T</h1><p>a <b>b</b>c\n d<p>e</article><footer>f</footer>") == "T a bc d e"
    assert read("<main>x<aside>y</aside><form>z</form><div class='comments'>c</div></main>") == "x"
    assert read("<article><p>long text here</p></article><article class='comment'>a longer text than that</article>") == "long text here"
    assert read("<article>one</article>x<article>two</article>") == "one two"
    assert read("<p>a<script>if (a < b) { '</p>' }</script>b<!-- c --></p><div hidden>d</div>") == "ab"
    assert read("<title>t</title><ul><li>a<li>b</ul><div id=cookie-notice>n</div><br>c") == "a b c"


def test_templates_are_deleted(spark, tmp_path):
    rows = [(i, f"http://a.com/{i}", f"<body>{MENU}<div>page {i} says {i * i}</div></body>") for i in range(12)]
    rows += [(100, "http://b.com/1", f"<body>{MENU}<div>other</div></body>")]
    rows += [(200 + i, f"http://c.com/{i}", "<article><div>same text</div></article>") for i in range(8)]
    rows += [(300, None, None), (301, "x", ""), (0, "http://a.com/0", rows[0][2])]
    rows = [(*r, 1, "h") for r in rows]
    spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int, host string").write.parquet(
        str(tmp_path / "p")
    )
    pages = spark.read.parquet(str(tmp_path / "p"))
    done = html.extract_main_text(spark, pages).collect()
    text = {r.page_id: r.text for r in done}
    assert len(done) == len(rows) and all(r.n_chars == len(r.text) for r in done)
    assert all(text[i] == f"page {i} says {i * i}" for i in range(12))
    assert text[100] == "Home Shop other" and text[203] == "same text" and text[300] == text[301] == ""
    assert html.extract_main_text(spark, pages.filter("false")).count() == 0


def plain_rule(host, path):
    best = None
    for verdict, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, verdict)
    return best


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[end:].split("#")[0].split("?")[0]
    return rest[:end].translate(str.maketrans(urls.UPPER, urls.LOWER)), path


def test_rules(spark, sf_dir):
    url = {r.page_id: r.url for r in table(spark, sf_dir, "pages").select("page_id", "url").collect()}
    for r in queries.op8_link_trust(spark, sf_dir).collect():
        assert (r.host, r.path) == plain_parts(url[r.page_id])
        rule = plain_rule(r.host, r.path)
        assert r.rule == (rule and rule[0]) and (not rule or r.verdict == rule[1])
        assert r.verdict in ("allow", "block")


def test_trust_follows_links(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">l</a>' for h in hosts)
    rows = [
        (1, "http://good.com/", link("friend.org")),
        (2, "http://friend.org/", ""),
        (3, "http://bad.net/es/", ""),
        (4, "http://spam.org/", link("bad.net", "bad.net")),
        (5, "http://alone.org/a?b#c", "<a href='/x'>own</a>"),
        (6, "no url", None),
        (7, None, link("bad.net")),
        (8, "HTTP://BAD.net/en", link("friend.org")),
        (8, "HTTP://BAD.net/en", link("friend.org")),
    ]
    rows = [(*r, "h", 1.0) for r in rows]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, trust double").repartition(2)
    got = sorted((r.page_id, r.verdict, r.host) for r in urls.judge_urls(spark, pages).collect())
    assert [v for _, v, _ in got] == ["allow", "allow", "block", "block", "allow", "allow", "allow", "block", "block"]
    assert got[-1][2] == "bad.net"
    assert urls.judge_urls(spark, pages.filter("false")).count() == 0


def link_page(*hosts):
    return "".join(f'<a href="http://{h}/x">l</a>' for h in hosts)


def test_scores_equal_plain_pagerank(spark, monkeypatch):
    """A graph with cycles, a hub in several parts and mixed seeds, against sums in plain Python."""
    monkeypatch.setattr(urls, "EDGES", 4)
    rng = random.Random(5)
    hosts = [f"h{i}.org" for i in range(25)] + ["a.com", "b.com", "c.net", "d.net"]
    rows = []
    for i, h in enumerate(hosts):
        to = rng.sample(hosts, 20 if i == 3 else rng.randrange(4))
        path = "es/" if h.endswith(".net") else ""
        rows.append((i, f"http://{h}/{path}", link_page(*to)))
    rows.append((99, "http://c.net/other", link_page("h1.org", "a.com")))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")

    weight = Counter()
    for _, url, page in rows:
        host = plain_parts(url)[0]
        weight.update((host, t) for t in set(re.findall("http://([^/]+)/x", page)) if t != host)

    def scores(seeds, links):
        out = Counter()
        for (s, _), w in links.items():
            out[s] += w
        total, gain = Counter(seeds), dict(seeds)
        for _ in range(400):
            moved = Counter()
            for (s, t), w in links.items():
                moved[t] += 0.85 * gain.get(s, 0.0) * w / out[s]
            gain = moved
            total.update(moved)
        return total

    trust = scores({"a.com": 1.0, "b.com": 1.0}, weight)
    distrust = scores({"c.net": 1.0, "d.net": 1.0}, {(t, s): w for (s, t), w in weight.items()})
    for r in urls.judge_urls(spark, pages).collect():
        assert abs(r.trust - trust[r.host]) < 0.02 and abs(r.distrust - distrust[r.host]) < 0.02
        if not r.rule and abs(distrust[r.host] - trust[r.host] - urls.FLOOR) > 0.02:
            assert r.verdict == ("block" if distrust[r.host] > trust[r.host] else "allow")


def test_verdicts_do_not_depend_on_the_rest_of_the_corpus(spark):
    """A chain of twelve hosts that leads to a blocked one, alone and beside many blocked urls."""
    chain = [(0, "http://bad.net/es/", "")]
    chain += [(i, f"http://s{i}.org/", link_page("bad.net" if i == 1 else f"s{i - 1}.org")) for i in range(1, 13)]
    chain += [(20, "http://good.com/", link_page("friend.org")), (21, "http://friend.org/", link_page("s1.org"))]
    alone = spark.createDataFrame(chain, "page_id bigint, url string, html string")
    many = spark.range(100, 50_100).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("http://x"), F.col("id") % 20_000, F.lit(".net/fr/")).alias("url"),
        F.lit("").alias("html"),
    )
    verdicts = [
        sorted((r.page_id, r.verdict) for r in urls.judge_urls(spark, p).filter("page_id < 100").collect())
        for p in (alone, alone.unionByName(many))
    ]
    assert verdicts[0] == verdicts[1]
    assert dict(verdicts[0]) == {**{i: "block" for i in range(13)}, 20: "allow", 21: "allow"}


def test_boxes_of_the_site_inside_articles(spark):
    """A box on all articles of a host goes, a passage on a third of them stays, and so do
    all articles of a page, but not the text between."""
    box = "<section><h2>About us</h2><p>We are a site.</p></section>"
    page = lambda i: (
        f"<p>out</p><article><p>story {i}</p>{box}{'<p>shared passage</p>' if i % 3 == 0 else ''}</article>"
        f"<p>between</p><article><div><p>second {i}</p></div></article>"
    )
    rows = [(i, f"http://a.com/{i}", page(i)) for i in range(18)]
    rows.append((50, "http://b.com/", page(50)))
    done = html.extract_main_text(spark, spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    text = {r.page_id: r.text for r in done.collect()}
    for i in range(18):
        assert text[i] == f"story {i}{' shared passage' if i % 3 == 0 else ''} second {i}"
    assert text[50] == "story 50 About us We are a site. second 50"


def test_deep_pages_take_linear_time():
    deep = "<div>x" * 40_000 + "</div>" * 40_000
    text, outer, inner = html.read_page(deep)
    assert text == " ".join("x" * 40_000) and len(outer) == 40_000 and not inner


def test_given_pages_equal_brute_force(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url", "html").collect()
    read = {r.page_id: (plain_parts(r.url)[0], *html.read_page(r.html or "")) for r in rows}
    drop = {}
    for host in {v[0] for v in read.values()}:
        own = [v for v in read.values() if v[0] == host]
        texts = {v[1] for v in own}
        inner = set().union(*[v[3] for v in own])
        for h in set().union(*[v[2] | v[3] for v in own]):
            n = len({v[1] for v in own if h in v[2] | v[3]})
            if n >= html.MIN_PAGES and n >= len(texts) * (html.INNER_SHARE if h in inner else html.MIN_SHARE):
                drop.setdefault(host, set()).add(h)
    want = {r.page_id: html.read_page(r.html or "", frozenset(drop.get(read[r.page_id][0], ())))[0] for r in rows}
    got = {r.page_id: r.text for r in queries.op1_site_templates(spark, sf_dir).collect()}
    assert got == want
