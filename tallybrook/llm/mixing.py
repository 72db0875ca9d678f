"""Mixing sources to target weights.

Tokens are aggregated per source, each source gets a target from its weight, and a
document is emitted floor(rate) times plus one more time with probability equal to the
fraction of the rate. The draw is a hash of the document id and the seed, so reruns agree.
Only DataFrame functions run.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import salted_join, stage, words

# Fixed values.
WEIGHTS = (1, 2, 3)  # by source in code-point order, null last, repeating
MAX_REPEATS = 3
SEED = "mix-1"


def source_targets(spark, sizes, source="source", weights=WEIGHTS, cap=MAX_REPEATS):
    """One row per source: `source_size`, `weight`, `target`.

    `sizes` has the columns `source` and `size`. The targets share the total by weight and
    stop at `cap` times the source's size; what that leaves is shared again by weight
    until none is above. The level is found in one pass over the sources ordered by
    cap / weight: once every source below a level is capped, the rest fit under it. The
    ordering holds one row per source, never documents.
    """
    per = sizes.groupBy(source).agg(F.sum("size").cast("bigint").alias("source_size"))
    per = stage(spark, per, "mix-sources")
    order = Window.orderBy(F.col(source).isNull(), F.col(source))
    rank = (F.row_number().over(order) - 1) % len(weights)
    weighed = per.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), rank).cast("bigint"))
    # exact comparison of size / weight: cross-multiplied by the product of all weights
    product = reduce(lambda a, b: a * b, weights)
    unit = F.col("source_size") * F.floor(F.lit(product) / F.col("weight")).cast("bigint")
    up = Window.orderBy(unit, F.col("weight"), F.col(source).isNull(), F.col(source))
    whole = Window.partitionBy(F.lit(1))
    d = weighed.withColumns(
        {
            "unit": unit,
            "below": F.coalesce(
                F.sum("source_size").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
            "open_weight": F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(whole),
        }
    )
    # with the sources below capped, does this one stay under its cap?
    rest = F.col("total") - cap * F.col("below")
    fits = rest * product <= cap * F.col("unit") * F.col("open_weight")
    d = d.withColumns({"rest": rest, "fits": fits})
    level = F.min(
        F.when(
            F.col("fits"),
            F.struct("unit", "weight", F.col(source).isNull().alias("z"), source, "rest", "open_weight"),
        )
    ).over(whole)
    d = d.withColumn("level", level)
    share = (F.col("level.rest") * F.col("weight")).cast("double") / F.col("level.open_weight")
    target = F.when(F.col("fits"), share).otherwise((cap * F.col("source_size")).cast("double"))
    return d.select(source, "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def draw(row_id, seed=SEED):
    """Number in [0, 1) fixed by the row id and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(row_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def plan_mix(spark, docs, row_id="doc_id", text="text", source="source", **options):
    """`row_id`, `source`, `size`, `source_size`, `target`, `copies` and `taken` per row of `docs`.

    The size is the number of words of the whole text; null texts have size 0 and stay in
    the plan. A null source is a source of its own. Rows with the same id draw alike.
    Sources without any word get target 0 and no copies.
    """
    sizes = docs.select(row_id, source, F.size(words(F.col(text))).cast("bigint").alias("size"))
    sizes = stage(spark, sizes, "mix-sizes")
    targets = stage(spark, source_targets(spark, sizes, source, **options), "mix-targets")
    cap = options.get("cap", MAX_REPEATS)
    d = salted_join(sizes, targets.drop("weight"), [source], [row_id])
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap))))
    d = d.withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    copies = F.floor("rate") + (draw(row_id) < F.col("rate") - F.floor("rate")).cast("bigint")
    d = d.withColumn("copies", copies)
    return d.withColumn("taken", F.col("copies") * F.col("size"))


def mix_documents(spark, docs, row_id="doc_id", text="text", source="source", **options):
    """The mixed corpus: every row of `docs` as often as its rate and draw say, all
    columns kept. While the table of sources is small, Spark sends it to the documents;
    beyond that the join is salted, so that no source fills a task."""
    sizes = docs.select(source, F.size(words(F.col(text))).cast("bigint").alias("size"))
    targets = stage(spark, source_targets(spark, sizes, source, **options), "mix-targets")
    cap = options.get("cap", MAX_REPEATS)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap))))
    rates = targets.select(source, F.coalesce(rate, F.lit(0.0)).alias("__rate"))
    d = salted_join(docs, rates, [source], [row_id])
    whole = F.floor("__rate")
    copies = whole + (draw(row_id) < F.col("__rate") - whole).cast("bigint")
    emitted = d.withColumn("__n", copies.cast("int")).filter("__n > 0")
    return emitted.withColumn("__c", F.explode(F.array_repeat(F.lit(0), F.col("__n")))).select(*docs.columns)


MIX_SQL = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1, 2, 3][1 + ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3)::INT] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, source_size * (6 // weight) AS unit,
         sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(weight) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM per WINDOW up AS (ORDER BY source_size * (6 // weight), weight, source IS NULL, encode(source))
), judged AS (
  SELECT *, total - 3 * below AS rest, (total - 3 * below) * 6 <= 3 * unit * open_weight AS fits FROM levels
), first AS (
  SELECT rest, open_weight FROM judged WHERE fits
  ORDER BY unit, weight, source IS NULL, encode(source) LIMIT 1
), targets AS (
  SELECT j.source, j.source_size,
         coalesce(CASE WHEN fits THEN (first.rest * j.weight)::DOUBLE / first.open_weight::DOUBLE
                       ELSE (3 * j.source_size)::DOUBLE END, 0.0) AS target
  FROM judged j LEFT JOIN first ON true
), rated AS (
  SELECT s.doc_id, s.size::BIGINT AS size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0) ELSE 0.0 END AS rate,
         ('0x' || substr(md5('{SEED}:' || coalesce(s.doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (u < rate - floor(rate))::BIGINT))::BIGINT AS taken
FROM rated
"""
