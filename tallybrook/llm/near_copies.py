"""Near copies by improved consistent weighted sampling.

Shingles of five words are weighted by TF-IDF with exact document frequencies: the inverse
frequency of a shingle is log(1 + N / df), and that of one in less than a 1/COMMON of the documents
is the same for all, log(1 + COMMON). So weights follow shares and are alike at every size, and
only the common shingles need to be known, of which there are at most COMMON times the shingles of
a mean document. A sketch that never counts too low finds the shingles that may be common; those
are counted exactly.

Each text gets BANDS x ROWS weighted samples; texts that agree on a whole band meet in a bucket.
Pairs of a bucket whose samples agree often enough for a similarity of 0.8 are compared on their
texts. Texts of equal words are one member.

A bucket of any size costs one comparison per member at first: with its smallest id. After these
stars are joined to components, only members of a bucket that are in different components may be
compared. The weight of a text's shingles that no other such text has is counted exactly; no
partner shares it, so a text with too much of it has none. The others are compared with the ORIGINS
members of their bucket that have the least of it, likely origins of its copies, and joined again.
Only pairs that are still in different components are then compared, if their shared weights and their
sketches of 512 more samples allow it. So no group of copies is expanded into its pairs.
"""

import zlib

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import SPACES, stage
from .components import connected

# Fixed values.
SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 3  # a pair at 0.8 shares no band with probability 1e-5
SAMPLES = BANDS * ROWS
AGREE = 22  # of 48 samples; at a similarity of 0.8 fewer agree with probability 1e-7
SKETCH = 512  # samples of one bit each, of texts with a likely partner in another component
APART = 80  # bits that may differ; at a similarity of 0.8 more do with probability 1e-5
ORIGINS = 8  # members of a bucket that all others are compared with before pairs are
COMMON = 256  # shingles in less than this share of the documents weigh alike
CELLS, BLOCKS, DEPTH = 1 << 20, 32, 2  # sketch
FAN_IN = 64
PARTNERS = 256  # texts that one task compares with a text

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FIRST = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x):
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


_ALL_SEEDS = (_mixed(np.arange(1, SAMPLES + SKETCH + 1, dtype=np.uint64) * _FIRST) >> np.uint64(32)).astype(np.uint32)
_SEEDS, _SKETCH_SEEDS = _ALL_SEEDS[:SAMPLES, None], _ALL_SEEDS[SAMPLES:, None]


_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_IS_SPACE = np.isin(np.arange(256), [ord(c) for c in SPACES])
_POWERS = np.full(1 << 16, np.uint64(0x9E3779B97F4A7C15)).cumprod(dtype=np.uint64)
SEGMENT = 1 << 20  # bytes of a text that are hashed at once


def word_hashes(text):
    """One 64-bit hash per word: sums of byte values times powers of their place."""
    raw = np.frombuffer(text.encode(errors="surrogatepass"), np.uint8)
    if len(raw) <= SEGMENT:
        return _segment_hashes(raw)
    # segments end at white space, so that no word is cut
    spaces, parts, at = np.flatnonzero(_IS_SPACE[raw]), [], 0
    while at < len(raw):
        i = np.searchsorted(spaces, at + SEGMENT)
        end = int(spaces[i]) if i < len(spaces) else len(raw)
        parts.append(_segment_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts)


def _segment_hashes(raw):
    inside = ~_IS_SPACE[raw]
    edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts = np.flatnonzero(edges == 1)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.flatnonzero(edges == -1) - starts
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = _BYTES[raw[inside]]
    value *= _POWERS[place & 0xFFFF] + (place >> 16).astype(np.uint64)
    return _mixed(np.add.reduceat(value, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def shingles(h):
    """Hashes of all runs of five words; a shorter text is one shingle."""
    if not len(h):
        return h
    size = min(SHINGLE, len(h))
    total = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        total = _mixed(total * np.uint64(0x2545F4914F6CDD1D) + h[i : len(h) - size + 1 + i])
    return total


def _cells(hashes, row):
    return (_mixed(hashes + np.uint64(row * 0x9E37 + 1)) & np.uint64(CELLS - 1)).astype(np.int64)


def document_frequencies(spark, texts):
    """Number of documents, and the common shingles (sorted hashes) with their exact document
    frequencies: those in more than 1/COMMON of the documents.

    Every task counts its documents in a sketch of fixed size and emits it in blocks; blocks
    are added up in rounds of at most FAN_IN, whatever the number of tasks. A second scan
    counts the shingles whose cells all are large enough.
    """

    def count(frames):
        table, n = np.zeros((DEPTH, CELLS), np.int64), 0
        waiting, size = [], 0

        def add_waiting():
            if waiting:
                own = np.concatenate(waiting)
                for row in range(DEPTH):
                    table[row] += np.bincount(_cells(own, row), minlength=CELLS)

        for f in frames:
            for text in f["text"]:
                own = np.unique(shingles(word_hashes(text))) if text else ()
                if len(own):
                    n += 1
                    waiting.append(own)
                    size += len(own)
                    if size > CELLS:
                        add_waiting()
                        waiting, size = [], 0
        add_waiting()
        part = TaskContext.get().partitionId()
        blocks = np.split(table.reshape(-1), BLOCKS)
        yield pd.DataFrame(
            {
                "block": [*range(BLOCKS), -1],
                "part": part,
                "counts": [zlib.compress(b.astype("<u8").tobytes(), 1) for b in blocks] + [zlib.compress(np.array([n], "<u8").tobytes())],
            }
        )

    def add(frame):
        total = sum(np.frombuffer(zlib.decompress(c), "<u8") for c in frame["counts"])
        return pd.DataFrame(
            {"block": [frame["block"].iloc[0]], "part": [frame["part"].iloc[0] // FAN_IN], "counts": [zlib.compress(total.astype("<u8").tobytes(), 1)]}
        )

    schema = "block int, part int, counts binary"
    d = stage(spark, texts.select("text").mapInPandas(count, schema), "near-df")
    parts = (d.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        d = d.groupBy("block", F.floor(F.col("part") / FAN_IN).alias("g")).applyInPandas(add, schema)
        parts = -(-parts // FAN_IN)
        if parts == 1:
            break
        d = stage(spark, d, "near-df")
    got = {r["block"]: np.frombuffer(zlib.decompress(r["counts"]), "<u8") for r in d.collect()}
    n = int(got[-1][0]) if got else 0
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if not n:
        return n, none
    large = np.concatenate([got[b] for b in range(BLOCKS)]).reshape(DEPTH, CELLS) > n // COMMON
    if not large.any(axis=1).all():
        return n, none
    large = spark.sparkContext.broadcast(large)  # of fixed size

    def count_common(frames):
        for f in frames:
            found = []
            for text in f["text"]:
                own = shingles(word_hashes(text)) if text else ()
                for row in range(DEPTH):
                    if len(own):
                        own = own[large.value[row][_cells(own, row)]]
                if len(own):
                    found.append(np.unique(own))
            own, df = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pd.DataFrame({"shingle": own.view(np.int64), "df": df.astype(np.int64)})

    common = texts.select("text").mapInPandas(count_common, "shingle bigint, df bigint")
    common = common.groupBy("shingle").agg(F.sum("df").alias("df")).filter(F.col("df") > n // COMMON).toPandas()
    own = common["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(own)
    return n, (own[order], common["df"].to_numpy(np.int64)[order])


def idf_table(n, common):
    """(hashes, weights) of the common shingles; any other weighs 1."""
    own, df = common
    return own, (np.log1p(n / np.maximum(df, n / COMMON)) / np.log1p(COMMON)).astype(np.float32)


def weigh(h, idf):
    """Distinct shingles of a text, sorted, and their TF-IDF weights."""
    own, tf = np.unique(shingles(h), return_counts=True)
    weights = tf.astype(np.float32)
    if len(idf[0]):
        at = np.minimum(np.searchsorted(idf[0], own), len(idf[0]) - 1)
        weights[idf[0][at] == own] *= idf[1][at[idf[0][at] == own]]
    return own, weights


def _gamma_table(bits):
    """Quantiles of the Gamma(2, 1) distribution at the centres of 2**bits equal steps."""
    p = (np.arange(1 << bits) + 0.5) / (1 << bits)
    x = np.sqrt(2 * p) + p
    for _ in range(60):  # Newton steps on 1 - (1 + x) exp(-x) = p
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x) + 1e-12), 1e-6)
    return x.astype(np.float32)


# What 32 random bits stand for: 8 choose r from Gamma(2, 1), 8 choose beta, 16 choose c from Gamma(2, 1).
_R = np.repeat(_gamma_table(8), 256)
_BETA = np.tile((np.arange(256, dtype=np.float32) + np.float32(0.5)) / np.float32(256), 256)
_PLAIN = _R * (1 - _BETA)  # what is taken off ln c at a weight of one
_LOG_C = np.log(_gamma_table(16))
_AT_ONCE = 24_576  # cells: element times sample


def samples(own, weights, seeds=_SEEDS):
    """One consistent weighted sample (element and its level, hashed) of a text per seed.

    A hash of element and sample gives all that is random. The level of a weight is
    t = floor(ln w / r + beta), and the element with the least c / (exp(r (t - beta)) exp(r)) is the
    sample. At a weight of one, which most have, t is zero and the rest a table.
    """
    width = len(seeds)
    best = np.full(width, np.inf, np.float32)
    key = np.zeros(width, np.uint64)
    columns, chunk = np.arange(width), _AT_ONCE // width
    plain = weights == 1
    for is_plain, of in ((True, own[plain]), (False, own[~plain])):
        logs = None if is_plain else np.log(weights[~plain])
        for at in range(0, len(of), chunk):
            part = of[at : at + chunk]
            z = part.astype(np.uint32)[None, :] ^ seeds
            z *= np.uint32(0x85EBCA6B)
            z ^= z >> np.uint32(15)
            z *= np.uint32(0xC2B2AE35)
            z ^= z >> np.uint32(16)
            value, low = _LOG_C[z >> np.uint32(16)], z & np.uint32(0xFFFF)
            if is_plain:
                value -= _PLAIN[low]
            else:
                r, beta = _R[low], _BETA[low]
                t = np.floor(logs[None, at : at + chunk] / r + beta)
                value -= r * (t - beta + 1)
            row = value.argmin(axis=1)
            least = value[columns, row]
            level = np.zeros(width, np.int64) if is_plain else t[columns, row].astype(np.int64)
            better = least < best
            best = np.where(better, least, best)
            key = np.where(better, _mixed(part[row] ^ _mixed(level.view(np.uint64) + _FIRST)), key)
    return key


def similarity(a, b):
    """Weighted Jaccard similarity of two (sorted shingles, weights)."""
    i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)[1:]
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    both = np.minimum(x[i], y[j]).sum()
    return both / (x.sum() + y.sum() - both)


def _sign(idf):
    def run(frames):
        table, done = idf.value, {}  # done: copies are signed once a task
        for f in frames:
            rows = []
            for doc_id, text in zip(f["id"], f["text"]):
                h = word_hashes(text) if text else ()
                if not len(h):
                    continue
                n = np.arange(1, len(h) + 1, dtype=np.uint64)
                same = (int(_mixed(h * (2 * n + 1)).sum()), int(_mixed(h + _mixed(n)).sum()))
                if same not in done:
                    if len(done) >= 20_000:
                        done.clear()
                    got = samples(*weigh(h, table))
                    bands = _mixed(got.reshape(BANDS, ROWS) * np.array([1, 3, 5], np.uint64))
                    bands = _mixed(bands.sum(axis=1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    done[same] = bands, got.view(np.int8)[::8]
                rows.append((doc_id, *(np.uint64(s).astype(np.int64) for s in same), *done[same]))
            yield pd.DataFrame(rows, columns=["id", "s1", "s2", "bands", "short"])

    return run


def _compare(idf, threshold):
    """Over rows sorted by cell (a, part) whose text `a` comes first: links of the cell."""

    def run(frames):
        table, cell, left = idf.value, None, None
        for f in frames:
            out = []
            for a, part, other, other_id, text in zip(f["a"], f["part"], f["other"], f["id"], f["text"]):
                if not other:
                    if cell != (a, part):  # the first text of an id counts
                        cell, left = (a, part), weigh(word_hashes(text), table)
                elif similarity(left, weigh(word_hashes(text), table)) >= threshold:
                    out.append((a, other_id))
            yield pd.DataFrame(out, columns=["a", "b"])

    return run


def _weighed(idf):
    def run(frames):
        table = idf.value
        for f in frames:
            got = [weigh(word_hashes(text), table) for text in f["text"]]
            yield pd.DataFrame(
                {
                    "id": f["id"],
                    "total": [w.sum(dtype=np.float64) for _, w in got],
                    "shingles": [own.view(np.int64) for own, _ in got],
                    "weights": [w for _, w in got],
                }
            )

    return run


def _sketch(frames):
    for f in frames:
        bits = []
        for own, weights in zip(f["shingles"], f["weights"]):
            key = samples(np.asarray(own, np.int64).view(np.uint64), np.asarray(weights, np.float32), _SKETCH_SEEDS)
            bits.append(np.packbits((key >> np.uint64(40)).astype(np.uint8) & 1).view(np.int64))
        yield pd.DataFrame({"id": f["id"], "bits": bits})


def _links(texts, pairs, idf, threshold):
    """The pairs (a, b) whose texts are similar. A text with many partners is compared in
    several cells of at most about PARTNERS, so that no task gets them all."""
    counts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")
    others = pairs.join(counts, "a").select("a", part.alias("part"), F.lit(True).alias("other"), F.col("b").alias("id"))
    firsts = others.select("a", "part").distinct().select("a", "part", F.lit(False).alias("other"), F.col("a").alias("id"))
    wanted = firsts.unionByName(others).join(texts, "id").select("a", "part", "other", "id", "text")
    dealt = wanted.repartition("a", "part").sortWithinPartitions("a", "part", "other", "id")
    return dealt.mapInPandas(_compare(idf, threshold), "a bigint, b bigint")


def _agreement(x, y):
    same = F.zip_with(x, y, lambda p, q: (p == q).cast("int"))
    return F.aggregate(same, F.lit(0), lambda s, v: s + v)


def _agreeing(pairs, shorts):
    """The pairs whose samples agree often enough."""
    for side in "ab":
        pairs = pairs.join(shorts.select(F.col("id").alias(side), F.col("short").alias(f"short_{side}")), side)
    return pairs.filter(_agreement("short_a", "short_b") >= AGREE).select("a", "b")


def _unshared(weighed):
    """`id`, `alone`: the weight of the shingles that no other text of `weighed` has."""
    each = weighed.select("id", F.explode(F.arrays_zip("shingles", "weights")).alias("e"))
    each = each.select("id", F.col("e.shingles").alias("shingle"), F.col("e.weights").alias("weight"))
    holders = each.groupBy("shingle").agg(F.min("id").alias("id"), F.max("id").alias("z"), F.min("weight").alias("weight"))
    return holders.filter("id = z").groupBy("id").agg(F.sum("weight").alias("alone"))


def _side(frame, columns, x):
    return frame.select("key", *[F.col(c).alias(f"{c}_{x}") for c in columns])


def _may_link(threshold):
    """Whether the weights that texts a and b share with any others allow a link."""
    both = F.least("shared_a", "shared_b") * (1 + 1e-9)
    return both >= threshold * (F.col("total_a") + F.col("total_b") - both)


def _close():
    apart = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(SKETCH // 64)), F.lit(0))
    return apart <= APART


def near_copy_classes(spark, docs, row_id="doc_id", text="text", threshold=THRESHOLD):
    """`row_id`, `class_id` for every row of `docs`: the smallest id of its class.

    A class is a connected component of the links between texts whose weighted Jaccard
    similarity is `threshold` or more. Rows of equal words share a class. Null and empty texts
    are classes of their own; rows with a null id get a null class; rows that share an id are
    one document, whose text is the least of theirs. Other columns are ignored.
    """
    d = docs.select(F.col(row_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    usable = d.filter("id is not null and text is not null")
    n, common = document_frequencies(spark, usable)
    idf = spark.sparkContext.broadcast(idf_table(n, common))  # at most COMMON times a mean document
    signed = usable.mapInPandas(_sign(idf), "id bigint, s1 bigint, s2 bigint, bands array<bigint>, short array<tinyint>")
    signed = stage(spark, signed, "near-signed")
    alike = signed.groupBy("s1", "s2").agg(F.min(F.struct("id", "bands", "short")).alias("m"))
    reps = stage(spark, alike.select("s1", "s2", "m.id", "m.bands", "m.short"), "near-reps")
    own = reps.groupBy("id").agg(F.min(F.struct("short", "bands")).alias("m")).select("id", "m.short", "m.bands")

    members = reps.select("id", F.explode("bands").alias("key")).distinct()
    buckets = members.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z")
    met = stage(spark, members.join(buckets.select("key", "a"), "key"), "near-met")
    texts = usable.join(met.select("id").distinct(), "id").groupBy("id").agg(F.min("text").alias("text"))
    texts = stage(spark, texts, "near-texts")
    stars = _agreeing(met.filter("a < id").select("a", F.col("id").alias("b")).distinct(), own.select("id", "short"))
    stars = stage(spark, stars, "near-stars")
    first = stage(spark, _links(texts, stars, idf, threshold), "near-first")

    named = met.join(connected(spark, first), "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    named = stage(spark, named, "near-named")
    mixed = named.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("m")).filter("l < m").select("key")
    open_ = named.join(stage(spark, mixed, "near-mixed"), "key")
    # only texts with a likely partner in another component are weighed, and of those with a possible one sketched
    mine = stage(spark, open_.join(own, "id"), "near-open")
    other = mine.select(F.col("key").alias("k"), F.col("label").alias("l"), F.col("short").alias("s"))
    on = (F.col("key") == F.col("k")) & (F.col("label") != F.col("l")) & (_agreement("short", "s") >= AGREE)
    likely = mine.join(other, on, "left_semi").select("id").distinct()
    weighed = texts.join(likely, "id").select("id", "text")
    weighed = weighed.mapInPandas(_weighed(idf), "id bigint, total double, shingles array<bigint>, weights array<float>")
    weighed = stage(spark, weighed, "near-weighed")
    shared = F.col("total") - F.coalesce("alone", F.lit(0.0))
    shared = weighed.select("id", "total").join(_unshared(weighed), "id", "left").select("id", "total", shared.alias("shared"))
    known = stage(spark, mine.join(shared, "id"), "near-known")
    x, y = (_side(known, ("id", "label", "total", "shared", "short"), side) for side in "ab")
    on = (x["key"] == y["key"]) & (F.col("label_a") != F.col("label_b")) & _may_link(threshold)
    possible = x.join(y, on & (_agreement("short_a", "short_b") >= AGREE), "left_semi").select(F.col("id_a").alias("id")).distinct()
    sketched = weighed.join(possible, "id").select("id", "shingles", "weights").mapInPandas(_sketch, "id bigint, bits array<bigint>")
    full = stage(spark, known.join(stage(spark, sketched, "near-sketched"), "id").drop("short"), "near-full")

    # each bucket's likely origins with its members in other components
    columns = ("id", "label", "total", "shared", "bits")
    least_alone = Window.partitionBy("key").orderBy(1 - F.col("shared") / F.col("total"), "id")
    origins = full.withColumn("place", F.row_number().over(least_alone)).filter(F.col("place") <= ORIGINS)
    x, y = _side(origins, columns, "a"), _side(full, columns, "b")
    on = (x["key"] == y["key"]) & (F.col("label_a") != F.col("label_b")) & _may_link(threshold) & _close()
    spokes = x.join(y, on).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    both_ways = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
    spokes = stage(spark, spokes.join(both_ways, ["a", "b"], "left_anti"), "near-spokes")
    second = stage(spark, _links(texts, spokes, idf, threshold), "near-second")
    labels = full.select("id", "label").distinct()
    for side in "ab":
        merged = (second if side == "a" else merged).join(labels.select(F.col("id").alias(side), F.col("label").alias(f"l{side}")), side)
    merged = connected(spark, merged.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    merged = merged.select(F.col("id").alias("label"), F.col("label").alias("to"))
    full = full.join(merged, "label", "left").withColumn("label", F.coalesce("to", "label"))
    full = stage(spark, full.drop("to"), "near-rest")

    columns = (*columns, "bands")
    x, y = (_side(full, columns, side) for side in "ab")
    common_bands = F.zip_with("bands_a", "bands_b", lambda p, q: F.when(p == q, p))
    on = (
        (x["key"] == y["key"])
        & (F.col("id_a") < F.col("id_b"))
        & (F.col("label_a") != F.col("label_b"))
        & _may_link(threshold)
        & _close()
        # each pair comes from the first bucket that it shares
        & (F.get(F.array_compact(common_bands), F.lit(0)) == x["key"])
    )
    cross = x.join(y, on).select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    done = stars.unionByName(spokes.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    cross = stage(spark, cross.join(done, ["a", "b"], "left_anti"), "near-cross")
    third = stage(spark, _links(texts, cross, idf, threshold), "near-third")
    classes = connected(spark, first.unionByName(second).unionByName(third))

    named = reps.join(classes, "id", "left").select("s1", "s2", F.coalesce("label", "id").alias("class_id"))
    named = stage(spark, named, "near-classes")
    per = signed.select("id", "s1", "s2").join(named, ["s1", "s2"]).groupBy("id").agg(F.min("class_id").alias("class_id"))
    done = d.select("id").join(per, "id", "left").select("id", F.coalesce("class_id", "id").alias("class_id"))
    return done.select(F.col("id").alias(row_id), "class_id")


def keep_one_of_each(spark, docs, row_id="doc_id", text="text"):
    """`docs` with one row of each class: the one with the smallest id. Rows that repeat an id
    count as one document; rows with a null id stay. All columns are kept."""
    classes = near_copy_classes(spark, docs, row_id, text)
    kept = classes.filter(F.col(row_id) == F.col("class_id")).select(row_id).distinct()
    kept = docs.join(kept, row_id).select(*docs.columns).dropDuplicates([row_id])
    return kept.unionByName(docs.filter(F.col(row_id).isNull()))
