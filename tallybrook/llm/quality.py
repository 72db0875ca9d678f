"""Quality rules: fixed rules, then robust multivariate outliers per language and source.

Each document becomes a short vector of transformed statistics. Per (language, source),
per language and for the whole corpus, which small groups fall back on, the minimum-covariance-determinant estimate is found by concentration steps: distances to
the current centre are binned, and the sums over the nearest share of the documents give
the next centre and covariance. One step is one aggregation with map-side combine; its
state is bounded by groups x bins, whatever share of the rows a group holds. Only
DataFrame functions run.
"""

from functools import reduce

from pyspark.sql import functions as F

from .common import WORD, salted_join, stage, words

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

STATS = ("x_len", "x_sym", "x_dup", "x_rep")
# Smallest spread that counts as normal for each statistic: without it the covariance of
# a group whose documents are all alike would be singular and every difference an outlier.
# They follow from what one event makes in a short text and leave that inside CUTOFF: the
# standard error of the mean word length of MIN_WORDS words, a symbol every eight words (2.5%
# of the word characters), one line said twice among eight (an eighth of the lines and a
# quarter of the words, together under 40%). Beyond, each statistic rejects by itself.
FLOORS = (0.08, 0.025, 0.1, 0.1)
SCALE = 1024  # statistics are whole multiples of 1/SCALE, so that sums are exact
SHARE = 0.75  # documents inside the concentrated part
STEPS = 3
MIN_GROUP = 30  # smaller groups are judged by their language, or else by the whole corpus
CUTOFF = 40.0  # squared distance; the 0.9999999 quantile for 4 statistics is about 39


def text_statistics(docs, text="text"):
    """Adds the base statistics of every whole text to `docs`; a null text is empty.

    A 3-word window counts as repeated if it is found twice or more in the text; windows
    are compared by 64-bit hash within their document.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumns({"__t": t, "__w": words(F.col(text))})
    grams = F.transform(
        F.sequence(F.lit(0), F.size("__w") - 3),
        lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)),
    )
    d = d.withColumn("__h", F.when(F.size("__w") >= 3, grams))
    # most texts repeat no window, which the distinct count shows; only the others sort
    repeats = F.size(F.array_distinct("__h")) < F.size("__h")
    placed = F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    d = d.withColumn("__g", F.when(repeats, F.sort_array(placed)))

    def same(k, j):
        return F.coalesce(F.get("__g", k)["h"] == F.get("__g", j)["h"], F.lit(False))

    at = F.transform(
        F.filter(
            F.sequence(F.lit(0), F.size("__g") - 1), lambda k: same(k, k - 1) | same(k, k + 1)
        ),
        lambda k: F.get("__g", k)["i"],
    )
    covered = F.aggregate(
        F.sort_array(at),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct(
            (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")
        ),
        lambda s: s["n"],
    )
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(WORD))
    d = d.withColumn("__lines", lines)
    return d.withColumns(
        {
            "n_words": F.size("__w").cast("bigint"),
            "word_chars": F.length(F.array_join("__w", "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace("__t", f"[^{SYMBOLS}]+", "")).cast("bigint"),
            "n_lines": F.size("__lines").cast("bigint"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.when(F.col("__g").isNull(), F.lit(0)).otherwise(covered).cast("bigint"),
        }
    ).drop("__t", "__w", "__h", "__g", "__lines")


def _vector():
    n = F.greatest(F.col("n_words"), F.lit(1))
    values = (
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        F.sqrt(F.col("n_repeat_words") / n),
    )
    return {name: F.round(v * SCALE).cast("bigint") for name, v in zip(STATS, values)}


def _total(columns):
    return reduce(lambda a, b: a + b, columns)


def _pairs():
    return [(i, j) for i in range(len(STATS)) for j in range(i + 1)]


def _distance():
    """Squared Mahalanobis distance by forward substitution on the Cholesky factor."""
    z = []
    for i, name in enumerate(STATS):
        v = F.col(name) / SCALE - F.col(f"m{i}")
        for j in range(i):
            v = v - F.col(f"l{i}{j}") * z[j]
        z.append(v / F.col(f"l{i}{i}"))
    return _total([v * v for v in z])


def _factor(moments, keys):
    """Centre and Cholesky factor of the regularised covariance from exact sums."""
    n = F.col("n")
    d = moments
    for i in range(len(STATS)):
        d = d.withColumn(f"m{i}", F.col(f"s{i}").cast("double") / n / SCALE)
    for i, j in _pairs():
        cov = F.col(f"s{i}{j}").cast("double") / n / (SCALE * SCALE) - F.col(f"m{i}") * F.col(f"m{j}")
        if i == j:
            cov = F.greatest(cov, F.lit(0.0)) + F.lit(FLOORS[i] ** 2)
        d = d.withColumn(f"c{i}{j}", cov)
    for i, j in _pairs():
        v = F.col(f"c{i}{j}")
        for k in range(j):
            v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        if i == j:
            v = F.sqrt(F.greatest(v, F.lit(FLOORS[i] ** 2)))
        else:
            v = v / F.col(f"l{j}{j}")
        d = d.withColumn(f"l{i}{j}", v)
    kept = [f"m{i}" for i in range(len(STATS))] + [f"l{i}{j}" for i, j in _pairs()]
    return d.select(*keys, "group_size", *kept)


def robust_estimates(spark, stats, keys, row_id):
    """Centre and covariance factor per group of `keys`, one row per group.

    `stats` holds the integer statistics. Starts from the coordinate-wise medians and
    interquartile ranges; each of STEPS concentration steps keeps the nearest SHARE.
    """
    quartiles = [F.lit(q) for q in (0.25, 0.5, 0.75)]
    start = stats.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_size"),
        *[F.percentile(x, F.array(*quartiles)).alias(f"q{i}") for i, x in enumerate(STATS)],
    )
    columns = {}
    for i, j in _pairs():
        if i == j:
            spread = (F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / SCALE / 1.349
            columns[f"m{i}"] = F.col(f"q{i}")[1] / SCALE
            columns[f"l{i}{j}"] = F.sqrt(spread * spread + F.lit(FLOORS[i] ** 2))
        else:
            columns[f"l{i}{j}"] = F.lit(0.0)
    fit = stage(spark, start.withColumns(columns).drop(*[f"q{i}" for i in range(len(STATS))]), "quality-start")
    for _ in range(STEPS):
        near = salted_join(stats, fit, keys, [row_id])
        # 16 bins per doubling of the distance: bounded, and the same at every size
        ring = F.floor(F.log2(_distance() + F.lit(2.0**-8)) * 16).cast("int")
        sums = {f"s{i}": F.col(x) for i, x in enumerate(STATS)}
        sums |= {f"s{i}{j}": F.col(STATS[i]) * F.col(STATS[j]) for i, j in _pairs()}
        rings = (
            near.withColumn("ring", ring)
            .groupBy(*keys, "ring")
            .agg(
                F.max("group_size").alias("group_size"),
                F.count(F.lit(1)).alias("n"),
                *[F.sum(v.cast("decimal(20,0)")).alias(k) for k, v in sums.items()],
            )
        )
        # the rings of a group are few: cut them after the one that completes the share
        folded = rings.groupBy(*keys).agg(
            F.max("group_size").alias("group_size"),
            F.sort_array(F.collect_list(F.struct("ring", "n"))).alias("all"),
        )
        reach = F.aggregate(
            "all",
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("int").alias("last")),
            lambda s, r: F.when(s["n"] >= F.col("group_size") * SHARE, s).otherwise(
                F.struct((s["n"] + r["n"]).alias("n"), r["ring"].alias("last"))
            ),
            lambda s: s["last"],
        )
        limits = folded.select(
            *[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)], reach.alias("__last")
        )
        on = reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(keys)]
        )
        inner = rings.join(limits, on).filter("ring <= __last")
        moments = inner.groupBy(*keys).agg(
            F.max("group_size").alias("group_size"),
            F.sum("n").alias("n"),
            *[F.sum(k).alias(k) for k in sums],
        )
        # one row per group: written down, so that no plan holds more than one step
        fit = stage(spark, _factor(moments, keys), "quality-step")
    return fit


def _measured(docs, text):
    """Base statistics, the base verdict and the integer vector; the text goes."""
    judged = text_statistics(docs, text).drop(text)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return judged.withColumn("base_failed", failed).withColumns(_vector())


def _judged(measured, fit, keys, row_id):
    done = salted_join(measured, fit, keys, [row_id])
    distance = _distance()
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return done.withColumn("distance", distance).withColumn("kept", kept)


def _levels(keys):
    """A group and the larger ones it belongs to: (level, keys), smallest first."""
    depths = sorted({len(keys), min(1, len(keys)), 0}, reverse=True)

    def group(level, depth):
        values = [F.col(k) if i < depth else F.lit(None) for i, k in enumerate(keys)]
        return F.struct(F.lit(level).alias("__level"), *[v.alias(k) for k, v in zip(keys, values)])

    return len(depths) - 1, F.explode(F.array(*[group(i, n) for i, n in enumerate(depths)]))


def _estimated(spark, measured, keys, row_id):
    """The estimate that judges each group: its own, or that of the first level above it
    with MIN_GROUP documents, or that of the corpus, however small."""
    last, groups = _levels(keys)
    sound = measured.filter("not base_failed").select(row_id, *STATS, groups.alias("g"))
    sound = sound.select(row_id, *STATS, "g.*")
    fits = robust_estimates(spark, sound, ["__level", *keys], row_id)
    own = [f"__own{i}" for i in range(len(keys))]
    wanted = fits.filter("__level = 0").select(*[F.col(k).alias(o) for k, o in zip(keys, own)], groups.alias("g"))
    on = F.col("g.__level") == F.col("__level")
    for k in keys:
        on = on & F.col("g")[k].eqNullSafe(F.col(k))
    found = wanted.join(fits, on).filter((F.col("group_size") >= MIN_GROUP) | (F.col("__level") == last))
    values = [c for c in fits.columns if c not in ("__level", *keys)]
    chosen = found.groupBy(*own).agg(F.min_by(F.struct(*values), "__level").alias("fit"))
    chosen = chosen.select(*[F.col(o).alias(k) for k, o in zip(keys, own)], "fit.*")
    return stage(spark, chosen, "quality-fit")


def judge_documents(spark, docs, keys=("lang", "source"), row_id="doc_id", text="text"):
    """Statistics and verdict for every row of `docs`.

    Returns `row_id`, the keys, the base statistics, `base_failed`, `distance` (null in
    groups where every document fails the base rules) and `kept`. Null texts count as empty, null keys
    form a group of their own, repeated rows are judged each; other columns are ignored.
    Documents that fail the base rules do not shape the estimates. An empty table gives
    no rows.
    """
    keys = list(keys)
    measured = stage(spark, _measured(docs.select(row_id, *keys, text), text), "quality")
    done = _judged(measured, _estimated(spark, measured, keys, row_id), keys, row_id)
    return done.select(
        row_id,
        *keys,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "distance",
        "kept",
    )


def keep_good_documents(spark, docs, keys=("lang", "source"), row_id="doc_id", text="text"):
    """The rows of `docs` that `judge_documents` keeps, all columns kept.

    The rows are written down next to their statistics, so that the texts are measured once and
    meet only the one row of their group's estimate.
    """
    keys = list(keys)
    whole = docs.select(row_id, *keys, text, F.struct(*docs.columns).alias("__row"))
    measured = stage(spark, _measured(whole, text), "quality-rows")
    done = _judged(measured, _estimated(spark, measured, keys, row_id), keys, row_id)
    return done.filter("kept").select("__row.*")
