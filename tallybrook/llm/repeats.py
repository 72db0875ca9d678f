"""Substring de-duplication over a de Bruijn graph of token k-mers.

A k-mer of words is an edge of the graph. Only one edge per window is kept: the smallest by
hash in it, so equal windows keep equal edges at equal places, and about one word in 22 has an
edge. Around an edge, every window that it stands for lies on the path of `WINDOW - K` words to
either side. Occurrences of an edge whose whole path is equal are one nonbranching path and
compact into one class, keyed by (edge, path hash): a Spark aggregation and a join replace all
of them by the class and its first document. Where an edge has several paths it branches, and
the source coordinates of one occurrence per class are verified window by window.

The work per word is constant, whatever the number of copies: no pairs are formed.
"""

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .common import WORD, stage

# Fixed value.
WINDOW = 50
K = 8
REACH = WINDOW - K  # words of path to either side of an edge

_SPLIT = re.compile(WORD)
_ODD = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_INVERSE = tuple(pow(b, -1, 1 << 64) for b in _ODD)
_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def split_words(text):
    return _SPLIT.findall(text) if text else []


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Hashes(dict):
    """64-bit hashes of words, and rolling hashes of word sequences."""

    LIMIT = 500_000

    def __init__(self):
        self.powers = [np.ones(1, np.uint64)] * 4

    def __missing__(self, word):
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = int.from_bytes(
            hashlib.blake2b(word.encode(errors="surrogatepass"), digest_size=8).digest(), "little"
        )
        return value

    def grow(self, n):
        if len(self.powers[0]) <= n:
            for i, base in enumerate((*_ODD, *_INVERSE)):
                steps = np.full(2 * n + 2, base, np.uint64)
                steps[0] = 1
                self.powers[i] = np.multiply.accumulate(steps)

    def prefixes(self, words):
        """Two arrays from which `between` reads the hash of any run of words."""
        n = len(words)
        self.grow(n)
        h = np.fromiter(map(self.__getitem__, words), np.uint64, n)
        sums = []
        for i, values in enumerate((h, _mixed(h))):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(values * self.powers[2 + i][:n], out=total[1:])
            sums.append(total)
        return sums

    def between(self, sums, i, start, end):
        return _mixed((sums[i][end] - sums[i][start]) * self.powers[i][start])


def edge_of_windows(grams):
    """For each window, the place of its smallest k-mer (the first of equals)."""
    bits = np.uint64(24 if len(grams) < 1 << 24 else 40)
    value = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    span, need = 1, REACH + 1
    while 2 * span <= need:
        value = np.minimum(value[:-span], value[span:])
        span *= 2
    rest = need - span
    value = np.minimum(value[: len(value) - rest], value[rest:])
    return (value & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _windows(hashes, sums, n):
    start = np.arange(n - K + 1)
    return edge_of_windows(hashes.between(sums, 0, start, start + K))


def _edges(docs):
    """(id, key, pos, edge, path) of the kept edges of every text of at least a window."""

    def run(frames):
        hashes = Hashes()
        for f in frames:
            cols = [[], [], [], [], []]
            for doc_id, key, text in zip(f["id"], f["key"], f["text"]):
                words = split_words(text)
                n = len(words)
                if n < WINDOW:
                    continue
                sums = hashes.prefixes(words)
                at = np.unique(_windows(hashes, sums, n))
                left, right = np.maximum(at - REACH, 0), np.minimum(at + K + REACH, n)
                edge = hashes.between(sums, 0, at, at + K)
                # a path cut by the end of the text is another path than one that goes on
                path = hashes.between(sums, 1, left, right) ^ _mixed((at - left).astype(np.uint64))
                path = _mixed(path + (right - at).astype(np.uint64))
                for c, v in zip(cols, (np.full(len(at), doc_id), np.full(len(at), key), at, edge.view(np.int64), path.view(np.int64))):
                    c.append(v)
            if cols[0]:
                joined = [np.concatenate(c) for c in cols]
                yield pd.DataFrame(dict(zip(("id", "key", "pos", "edge", "path"), joined)))

    return docs.mapInPandas(run, "id bigint, key bigint, pos int, edge bigint, path bigint")


def _covered(n, starts):
    """Mask of the words that windows at `starts` cover."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.asarray(starts, np.int64) + WINDOW, -1)
    return np.cumsum(step[:n]) > 0


SEEN = (
    "id bigint, key bigint, n_words bigint, n_removed bigint, kept string, text string,"
    " starts array<int>, windows array<struct<a:bigint,b:bigint,pos:int>>"
)
DONE = "id bigint, n_words bigint, n_removed bigint, kept string"


def _first_reading(with_hits):
    """Decides what the classes decide; hashes the windows of branching edges."""

    def run(frames):
        hashes = Hashes()
        for f in frames:
            rows = []
            for doc_id, key, text, hits in zip(f["id"], f["key"], f["text"], f["hits"]):
                words = split_words(text)
                n = len(words)
                if hits is None or n < WINDOW:
                    rows.append((doc_id, key, n, 0, " ".join(words), None, None, None))
                    continue
                hits = np.unique(np.asarray(hits, np.int64))
                sums = hashes.prefixes(words)
                edge = _windows(hashes, sums, n)
                gone = np.flatnonzero(np.isin(edge, hits[hits % 2 == 1] // 2))
                open_ = np.flatnonzero(np.isin(edge, hits[hits % 2 == 0] // 2))
                if not len(open_):
                    mask = _covered(n, gone)
                    kept = " ".join(w for w, m in zip(words, mask.tolist()) if not m)
                    rows.append((doc_id, key, n, int(mask.sum()), kept, None, None, None))
                    continue
                a = hashes.between(sums, 0, open_, open_ + WINDOW).view(np.int64).tolist()
                b = hashes.between(sums, 1, open_, open_ + WINDOW).view(np.int64).tolist()
                found = [{"a": x, "b": y, "pos": p} for x, y, p in zip(a, b, open_.tolist())]
                rows.append((doc_id, key, n, None, None, text, gone.tolist(), found))
            yield pd.DataFrame(
                rows, columns=["id", "key", "n_words", "n_removed", "kept", "text", "starts", "windows"], dtype=object
            )

    return with_hits.mapInPandas(run, SEEN)


def _last_reading(open_texts):
    def run(frames):
        for f in frames:
            rows = []
            for doc_id, n, text, starts, more in zip(f["id"], f["n_words"], f["text"], f["starts"], f["more"]):
                words = split_words(text)
                at = np.concatenate([np.asarray(x, np.int64) for x in (starts, more) if x is not None])
                mask = _covered(len(words), at)
                kept = " ".join(w for w, m in zip(words, mask.tolist()) if not m)
                rows.append((doc_id, n, int(mask.sum()), kept))
            yield pd.DataFrame(rows, columns=["id", "n_words", "n_removed", "kept"])

    return open_texts.mapInPandas(run, DONE)


def _keyed(spark, d):
    """With the `key` that tells rows of one id apart, a hash of their text. Ids that do not repeat
    need none: theirs is zero, which takes no room in a shuffle."""
    repeated = d.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    repeated = stage(spark, repeated.select("id"), "repeats-ids").withColumn("again", F.lit(True))
    key = F.when(F.col("again"), F.xxhash64("id", "text")).otherwise(F.lit(0).cast("bigint"))
    return d.join(repeated, "id", "left").select("id", "text", key.alias("key"))


def remove_repeats(spark, docs, row_id="doc_id", text="text"):
    """`row_id`, `n_words`, `n_removed`, `kept` (the words that stay, joined by one space).

    A word goes if a run of WINDOW words that covers it also starts in a row with a smaller
    id; runs are judged on the input. Sequences are compared by two 64-bit hashes. Null and
    empty texts have no words; rows with the same id do not judge each other; rows with a
    null id stay whole and judge nothing. Other columns are ignored.
    """
    d = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    d = _keyed(spark, d)
    edges = stage(spark, _edges(d.filter("id is not null").select("id", "key", "text")), "repeats-edges")
    classes = edges.groupBy("edge", "path").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    classes = stage(spark, classes, "repeats-classes")
    branches = classes.groupBy("edge").agg(F.count(F.lit(1)).alias("paths"), F.min("first").alias("a"), F.max("last").alias("b"))
    branching = stage(spark, branches.filter("paths > 1 and a < b").select("edge"), "repeats-branching")
    told = classes.join(branching.withColumn("branches", F.lit(True)), "edge", "left")
    told = told.filter("first < last or branches").select("edge", "path", "first", F.coalesce("branches", F.lit(False)).alias("branches"))
    told = stage(spark, told, "repeats-told")
    hits = edges.join(told, ["edge", "path"]).filter("first < id or branches")
    hits = hits.select("id", "key", (F.col("pos").cast("bigint") * 2 + (F.col("first") < F.col("id")).cast("int")).alias("hit"))
    per = hits.groupBy("id", "key").agg(F.collect_list("hit").alias("hits"))
    seen = stage(spark, _first_reading(d.join(per, ["id", "key"], "left").select("id", "key", "text", "hits")), "repeats-seen")

    windows = seen.filter("text is not null").select("id", "key", F.explode("windows").alias("w"))
    windows = windows.select("id", "key", "w.a", "w.b", "w.pos")
    first = windows.groupBy("a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = stage(spark, first.filter("first < last").drop("last"), "repeats-first")
    late = windows.join(first, ["a", "b"]).filter("first < id")
    more = late.groupBy("id", "key").agg(F.collect_set("pos").alias("more"))
    open_texts = seen.filter("text is not null").select("id", "key", "n_words", "text", "starts").join(more, ["id", "key"], "left")
    done = seen.filter("text is null").select("id", "n_words", "n_removed", "kept").unionByName(_last_reading(open_texts))
    return done.select(F.col("id").alias(row_id), "n_words", "n_removed", "kept")
