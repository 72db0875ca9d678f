"""URL filters: host and path rules, and trust propagated over the link graph of hosts.

Rules decide the urls they fit. For the others, trust starts at hosts with urls that a rule
allows and follows their links (personalised PageRank); distrust starts at hosts with urls
that a rule blocks and follows links backwards, to the pages that point there. A host is
blocked when its distrust outweighs its trust. Only DataFrame functions run; the graph is
aggregated to one row per pair of hosts before the first step.
"""

from functools import reduce

from pyspark.sql import functions as F

from .common import salted_join, stage

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
BLOCK_ABOVE = 1.0  # distrust over trust, plus the floor
FLOOR = 1e-2  # in units of the restart mass of one seed host, as are all scores
REST = 1e-3  # gain of a host in a step that is not followed further
EDGES = 1_000_000  # links of a host in one part
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def host_and_path(url):
    """(host, path) of a url column: empty for a null url or one without `://`."""
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host, path, rules=RULES):
    """Struct (verdict, rule) of the longest rule that fits, else null.

    A rule fits its host and all subdomains if the path starts with the rule's path.
    `rules` is a list given by the caller, so its size does not follow the data.
    """
    fits = []
    for verdict, h, p in rules:
        same = (host == F.lit(h)) | host.endswith(f".{h}")
        found = F.struct(
            F.lit(len(h) + len(p)).alias("size"), F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule")
        )
        fits.append(F.when(same & path.startswith(p), found))
    return F.greatest(*fits, F.lit(None)) if len(fits) > 1 else fits[0]


def host_edges(pages, url="url", html="html"):
    """`src`, `dst`, `weight`: pages of `src` times links to another host `dst`."""
    host, _ = host_and_path(F.col(url))
    links = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))
    target, _ = host_and_path(F.regexp_replace(F.col("link"), r"^//", "://"))
    pairs = pages.select(host.alias("src"), F.explode(F.array_distinct(links)).alias("link"))
    pairs = pairs.select("src", target.alias("dst")).filter("src <> dst and src <> '' and dst <> ''")
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def shares(spark, edges, name):
    """`src`, `part`, `dst`, `share`: the share of a host's links that goes to each target.

    The links of a host are cut into parts of about EDGES rows, so that a host which holds
    any share of all links is spread over tasks, and the others are not copied.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("all"), F.count(F.lit(1)).alias("n"))
    out = out.withColumn("parts", F.ceil(F.col("n") / EDGES).cast("bigint"))
    whole = salted_join(edges, out, ["src"], ["dst"])
    part = F.pmod(F.xxhash64("dst"), F.col("parts")).alias("part")
    rows = whole.select("src", part, "dst", (F.col("weight") / F.col("all")).alias("share"))
    parts = out.select(F.col("src").alias("host"), "parts")
    return stage(spark, rows, f"{name}-links"), stage(spark, parts, f"{name}-parts")


def propagate(spark, hosts, edges, seed, name):
    """Personalised PageRank of `hosts` (column `host`, `seed`) along `edges` (src, dst, weight).

    A step moves what the step before moved, so that only hosts the seeds reach take part; a
    score is the sum over the steps. They end when no host gains more than REST of a seed
    host's restart mass, or nothing moves at all. Mass on a host without outgoing links is lost.
    A step shrinks the mass by DAMPING, so the number of steps grows with the logarithm of the
    number of seed hosts at most.
    """
    links, parts = shares(spark, edges, name)
    gains = [hosts.filter(F.col(seed) > 0).select("host", F.col(seed).alias("gain"))]
    while True:
        open_parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))
        moving = gains[-1].join(parts, "host").select(F.col("host").alias("src"), "gain", open_parts.alias("part"))
        flow = links.join(moving, ["src", "part"]).groupBy(F.col("dst").alias("host"))
        gain = flow.agg((DAMPING * F.sum(F.col("gain") * F.col("share"))).alias("gain"))
        gain = stage(spark, gain, f"{name}-{len(gains)}")
        most = gain.agg(F.max("gain").alias("m")).first()["m"]
        if most is None:
            break
        gains.append(gain)
        if most <= REST:
            break
    total = reduce(lambda a, b: a.unionByName(b), gains).groupBy("host").agg(F.sum("gain").alias("score"))
    total = hosts.select("host").join(total, "host", "left")
    return stage(spark, total.select("host", F.coalesce("score", F.lit(0.0)).alias("score")), f"{name}-scores")


def judge_hosts(spark, judged, edges):
    """`host`, `trust`, `distrust`, `host_verdict` for every host of `judged` (host, verdict)
    and every host that is linked.

    Each seed host has a mass of one, divided between trust and distrust like its judged urls.
    So scores are in units of a seed host's restart mass, and what lies elsewhere in the
    corpus, linked to neither side of a host, does not move its verdict.
    """
    seeds = judged.groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").cast("double").alias("allowed"),
        F.count_if(F.col("verdict") == "block").cast("double").alias("blocked"),
    )
    own = F.col("allowed") + F.col("blocked")
    part = lambda c: F.when(own > 0, F.col(c) / own).otherwise(0.0)
    seeds = seeds.select("host", part("allowed").alias("good"), part("blocked").alias("bad"))
    linked = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    hosts = seeds.join(linked, "host", "full").na.fill(0.0, ["good", "bad"])
    hosts = stage(spark, hosts, "url-hosts")
    trust = propagate(spark, hosts, edges, "good", "url-trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = propagate(spark, hosts, back, "bad", "url-distrust")
    both = trust.withColumnRenamed("score", "trust").join(
        distrust.withColumnRenamed("score", "distrust"), "host"
    )
    blocked = F.col("distrust") > BLOCK_ABOVE * F.col("trust") + FLOOR
    return both.withColumn("host_verdict", F.when(blocked, "block").otherwise("allow"))


def judge_urls(spark, pages, row_id="page_id", url="url", html="html", rules=RULES):
    """`row_id`, `host`, `path`, `rule`, `verdict`, `trust`, `distrust` for every row.

    Null urls and urls without `://` have empty host and path, fit no rule and, as their
    host has no links and no seeds, are allowed. Null or empty html adds no links.
    Repeated rows are judged alike and count as so many pages of their host. Columns other
    than the three named are ignored.
    """
    host, path = host_and_path(F.col(url))
    d = pages.select(F.col(row_id), host.alias("host"), path.alias("path"))
    match = matching_rule(F.col("host"), F.col("path"), rules)
    d = d.withColumn("m", match).select(row_id, "host", "path", F.col("m.rule"), F.col("m.verdict"))
    edges = stage(spark, host_edges(pages, url, html), "url-links")
    # one row per host and verdict goes on; the pages themselves are read again at the end
    counts = judge_hosts(spark, d.select("host", "verdict"), edges)
    done = salted_join(d, stage(spark, counts, "url-scores"), ["host"], [row_id])
    return done.select(
        row_id,
        "host",
        "path",
        "rule",
        F.coalesce("verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
