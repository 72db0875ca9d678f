"""Running aggregates that never put an unbounded group into one task.

A plain `agg().over(partitionBy(group).orderBy(order))` sorts a whole group in
one task. Here a large group is cut into blocks along its order:

1. every block is reduced to one row (map-side combined),
2. those few rows are scanned per group, giving each block the value carried
   into it,
3. the carried value enters its block as an extra first row, and the ordinary
   window runs per (group, block).

Full rows are shuffled once, by (group, block), exactly as often as the plain
window would shuffle them.
"""

from dataclasses import dataclass

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Rows per block when blocks are cut from a per-partition offset.
BLOCK_ROWS = 250_000


@dataclass(frozen=True)
class Fold:
    """One running aggregate: `kind` is sum, max or last over `value`.

    `last` keeps the latest non-null value.
    """

    kind: str
    value: Column

    def over_rows(self, name, order):
        if self.kind == "sum":
            return F.sum(name)
        if self.kind == "max":
            return F.max(name)
        # max_by skips rows whose ordering is null, so null values never win
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.struct(*order)))

    def over_window(self, name, window):
        if self.kind == "sum":
            return F.sum(name).over(window)
        if self.kind == "max":
            return F.max(name).over(window)
        return F.last(name, ignorenulls=True).over(window)


def offset_block(column="offset", block_rows=BLOCK_ROWS):
    """Block number for a column that is unique, or nearly so, within a group."""
    return F.expr(f"`{column}` div {int(block_rows)}")


def running(rows, group, order, folds, block=None, split=None, seed=None, inclusive=True):
    """Add one running aggregate per entry of `folds` ({output name: Fold}).

    group      columns of the scan group
    order      columns giving a total order within the group
    block      Column, non-decreasing along `order` and never null; None runs the
               plain window
    split      boolean Column: only these rows are cut into blocks (hot groups);
               None cuts every row. It must have one value per group.
    seed       frame with `group` and the output names: values from before the
               first row; needs `block` without `split`
    inclusive  whether the current row counts
    """
    inputs = {f"_in_{name}": (name, fold) for name, fold in folds.items()}
    order_cols = [F.col(c) for c in order]
    upto = Window.unboundedPreceding, (0 if inclusive else -1)
    kept = rows.columns
    body = rows
    for source, (_, fold) in inputs.items():
        body = body.withColumn(source, fold.value)

    if block is None:
        window = Window.partitionBy(*group).orderBy(*order_cols).rowsBetween(*upto)
        return body.select(
            *kept, *[fold.over_window(s, window).alias(n) for s, (n, fold) in inputs.items()]
        )

    body = body.withColumn("_block", block if split is None else F.when(split, block))
    heads = (
        body.filter(F.col("_block").isNotNull())
        .groupBy(*group, "_block")
        .agg(*[fold.over_rows(s, order).alias(s) for s, (_, fold) in inputs.items()])
    )
    if seed is not None:
        before_all = F.lit(-(2**62)).cast("bigint").alias("_block")
        heads = heads.unionByName(
            seed.select(*group, before_all, *[F.col(n).alias(s) for s, (n, _) in inputs.items()])
        )
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = heads.select(
        *group,
        "_block",
        F.lit(0).alias("_row"),
        *[fold.over_window(s, earlier).alias(s) for s, (_, fold) in inputs.items()],
    )
    everything = body.withColumn("_row", F.lit(1)).unionByName(carried, allowMissingColumns=True)
    window = (
        Window.partitionBy(*group, "_block").orderBy("_row", *order_cols).rowsBetween(*upto)
    )
    return (
        everything.select(
            *kept,
            "_row",
            *[fold.over_window(s, window).alias(n) for s, (n, fold) in inputs.items()],
        )
        .filter(F.col("_row") == 1)
        .drop("_row")
    )
