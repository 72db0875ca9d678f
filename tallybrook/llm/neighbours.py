"""Approximate nearest neighbours: NN-descent in Spark joins, then greedy graph search.

Equal vectors are one node. Random-projection blocks give every node its first neighbours.
Then, round by round, each node joins its neighbours and the nodes that list it, compares
these with each other, and offers them what it found: neighbours of neighbours. A query walks
the graph from its own node and from the longest vectors, always expanding its best unexpanded
nodes. Graph work uses 8-bit codes of the directions; the scores that are returned come from the
original vectors in double precision.

Inner product is no metric, so the graph joins vectors of near directions, whatever their
lengths; a code holds a direction on a scale of its own and the length as a number, and the search
ranks by direction times length. So no vector, however long, coarsens the codes of others.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stage

K = 40  # neighbours kept per node
REVERSE = 20  # nodes that list a node, at most, in one round of it; others are met by their own lists
ROUNDS = 3
TREES = 12
LEAF = 200  # rows compared all with all
PART = 20_000  # rows of a block before it is split in memory
STEPS = 3
EXPAND = 24
KEEP = 80  # nodes a query remembers
LONGEST = 64  # longest vectors, where every query starts as well
TOP = 20
SEED = 7


def _code_type(dims):
    """Length relative to the longest vector, scale of the components, and the components."""
    return np.dtype([("length", "<f8"), ("scale", "<f4"), ("at", "i1", (dims,))])


def _encoded(rows, longest):
    """Codes of vectors (an array with one row each)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    codes = np.zeros(len(rows), _code_type(rows.shape[1]))
    most = np.abs(rows).max(axis=1)
    codes["length"], codes["scale"] = longest, most / 127
    codes["at"] = np.rint(rows / most[:, None] * 127)
    return [c.tobytes() for c in codes]


def _read(codes, dims):
    return np.frombuffer(b"".join(codes), _code_type(dims))


def _matrix(codes, dims):
    """The directions, one unit row per code."""
    own = _read(codes, dims)
    rows = own["at"].astype(np.float32) * own["scale"][:, None]
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _top(df, by, score, limit, tie):
    order = Window.partitionBy(by).orderBy(F.col(score).desc(), tie)
    return df.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= limit).drop("r")


def _leaves(rows, vectors, rng):
    """Splits a block at the median of random projections until its leaves are small."""
    todo = [rows]
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            yield own
            continue
        order = np.argsort(vectors[own] @ rng.standard_normal(vectors.shape[1]).astype(np.float32), kind="stable")
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]


def _first_graph(dims):
    def run(frames):
        pdf = pd.concat(list(frames), ignore_index=True)
        for tree, block in pdf.groupby("tree"):
            ids, vectors = block["node"].to_numpy(), _matrix(block["code"], dims)
            rng = np.random.default_rng(SEED + int(tree))
            for leaf in _leaves(np.argsort(ids, kind="stable"), vectors, rng):
                scores = vectors[leaf] @ vectors[leaf].T
                np.fill_diagonal(scores, -np.inf)
                k = min(K, len(leaf) - 1)
                if k < 1:
                    continue
                best = np.argpartition(-scores, k - 1, axis=1)[:, :k]
                yield pd.DataFrame(
                    {
                        "u": np.repeat(ids[leaf], k),
                        "v": ids[leaf][best].ravel(),
                        "score": np.take_along_axis(scores, best, 1).ravel(),
                    }
                )

    return run


def _local_join(dims):
    """Compares the neighbours of a node with each other; each learns of those that beat the
    last of its list."""

    def run(frames):
        for f in frames:
            us, vs, ss = [], [], []
            for nodes, codes, least in zip(f["vs"], f["codes"], f["least"]):
                ids, m = np.asarray(nodes), _matrix(codes, dims)
                ids, first = np.unique(ids, return_index=True)
                m, low = m[first], np.asarray(least, np.float32)[first]
                scores = m @ m.T
                np.fill_diagonal(scores, -np.inf)
                i, j = np.nonzero(scores > low[:, None])
                us.append(ids[i]), vs.append(ids[j]), ss.append(scores[i, j])
            if us:
                yield pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs), "score": np.concatenate(ss)})

    return run


def build_graph(spark, nodes, dims, count):
    """`u`, `v`, `score`: the K nearest nodes found for each row of `nodes` (node, code)."""
    edge = "u bigint, v bigint, score float"
    rng = np.random.default_rng(SEED)
    lines = rng.standard_normal((dims, TREES)).astype(np.float32)

    def project(frames):
        for f in frames:
            at = _matrix(f["code"], dims) @ lines
            n = len(f)
            yield pd.DataFrame(
                {
                    "tree": np.tile(np.arange(TREES, dtype=np.int32), n),
                    "at": at.ravel(),
                    "node": np.repeat(f["node"].to_numpy(), TREES),
                    "code": np.repeat(f["code"].to_numpy(), TREES),
                }
            )

    spread = nodes.mapInPandas(project, "tree int, at float, node bigint, code binary")
    parts = TREES * max(1, -(-count // PART))
    blocks = spread.repartitionByRange(parts, "tree", "at").select("tree", "node", "code")
    found = stage(spark, blocks.mapInPandas(_first_graph(dims), edge), "nn-first")
    graph = stage(spark, _top(found.distinct(), "u", "score", K, F.col("v")), "nn-0")
    for step in range(ROUNDS):
        last = graph.groupBy("u").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        last = last.select(F.col("u").alias("v"), F.when(F.col("n") >= K, F.col("least")).otherwise(float("-inf")).alias("least"))
        known = nodes.select(F.col("node").alias("v"), "code").join(last, "v", "left")
        known = stage(spark, known.select("v", "code", F.coalesce("least", F.lit(float("-inf"))).alias("least")), f"nn-known-{step}")
        back = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), F.xxhash64("u", "v", F.lit(step)).alias("score"))
        lists = graph.select("u", "v").unionByName(_top(back, "u", "score", REVERSE, F.col("v")).select("u", "v"))
        lists = lists.join(known, "v").groupBy("u").agg(F.collect_list(F.struct("v", "code", "least")).alias("l"))
        lists = lists.select(F.col("l.v").alias("vs"), F.col("l.code").alias("codes"), F.col("l.least").alias("least"))
        better = lists.mapInPandas(_local_join(dims), edge)
        merged = graph.unionByName(better).groupBy("u", "v").agg(F.max("score").alias("score"))
        graph = stage(spark, _top(merged, "u", "score", K, F.col("v")), f"nn-{step + 1}")
    return graph


def _scored(pairs, codes, queries, dims):
    """Adds the inner product of query and node, from the codes."""

    @F.pandas_udf("double")
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(a):
            return pd.Series([], dtype="float64")
        near = np.einsum("ij,ij->i", _matrix(a, dims), _matrix(b, dims), dtype=np.float64)
        return pd.Series(near * _read(b, dims)["length"])

    d = pairs.join(queries, "q").join(codes.withColumnRenamed("node", "v"), "v")
    return d.select("q", "v", score("qcode", "code").alias("score"))


def search_graph(spark, graph, codes, queries, longest, dims):
    """`q`, `v`: the KEEP best nodes found for each of `queries` (q, qcode); q is a node.
    `longest` (v) holds at most LONGEST nodes, where every query starts as well."""
    lists = stage(spark, graph.groupBy("u").agg(F.collect_list("v").alias("vs")), "nn-lists")
    start = queries.select("q").join(graph.select(F.col("u").alias("q"), "v"), "q")
    start = start.unionByName(queries.select("q", F.col("q").alias("v")))
    few = longest.agg(F.collect_list("v").alias("vs"))
    every = queries.select("q", F.lit(1).alias("one")).join(few.withColumn("one", F.lit(1)), "one")
    start = start.unionByName(every.select("q", F.explode("vs").alias("v"))).distinct()
    best = _scored(start, codes, queries, dims).withColumn("open", F.lit(True))
    best = stage(spark, best, "nn-beam-start")
    for step in range(STEPS):
        fresh = _top(best.filter("open"), "q", "score", EXPAND if step else K + 1, F.col("v")).select("q", "v")
        fresh = stage(spark, fresh, f"nn-fresh-{step}")
        met = fresh.join(lists.withColumnRenamed("u", "v"), "v").select("q", F.explode("vs").alias("v")).distinct()
        met = met.join(best.select("q", "v"), ["q", "v"], "left_anti")
        new = _scored(met, codes, queries, dims).withColumn("open", F.lit(True))
        done = best.join(fresh.withColumn("x", F.lit(True)), ["q", "v"], "left")
        done = done.select("q", "v", "score", (F.col("open") & F.col("x").isNull()).alias("open"))
        best = stage(spark, _top(done.unionByName(new), "q", "score", KEEP, F.col("v")), f"nn-beam-{step}")
    return best.select("q", "v")


def nearest_neighbours(spark, rows, is_query, row_id="vec_id", vector="embedding", top=TOP):
    """`query_id`, `rank`, `vec_id`, `score`: the `top` nearest rows found for each query row.

    `is_query` is a condition on `row_id`. Nearness is the inner product; ties go to the
    smaller id; a row is no neighbour of itself. Null and zero vectors, vectors that hold null
    or non-finite components, rows with a null id, and vectors of another length than most take
    no part. Rows that share an id count once per different vector. Other columns are ignored.
    """
    d = rows.select(F.col(row_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    d = d.filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("x", lambda v: v != 0))
    sizes = d.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), "dims").first()
    if sizes is None:
        return d.select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")
        )
    dims = sizes["dims"]
    d = stage(spark, d.filter(F.size("x") == dims).withColumn("key", F.sha2(F.to_json("x"), 256)), "nn-rows")
    # a node is the smallest id of a vector; the smallest ids of a node are all a query can want
    nodes = d.groupBy("key").agg(F.min(F.struct("id", "x")).alias("m")).select("key", F.col("m.id").alias("node"), "m.x")
    # the length as largest component times the length of the rest, which no square overflows
    largest = F.array_max(F.transform("x", lambda v: F.abs(v)))
    nodes = nodes.withColumn("largest", largest)
    squares = F.aggregate("x", F.lit(0.0), lambda s, v: s + (v / F.col("largest")) * (v / F.col("largest")))
    nodes = stage(spark, nodes.withColumn("unit", F.sqrt(squares)), "nn-nodes")
    most = nodes.agg(F.max("largest").alias("largest"), F.count(F.lit(1)).alias("n")).first()
    length = F.col("largest") / most["largest"] * F.col("unit")

    def encode(frames):
        for f in frames:
            x = np.stack(f["x"].to_numpy()).astype(np.float64)
            yield pd.DataFrame({"node": f["node"], "code": _encoded(x, f["length"].to_numpy())})

    codes = nodes.select("node", "x", length.alias("length")).mapInPandas(encode, "node bigint, code binary")
    codes = stage(spark, codes, "nn-codes")
    graph = build_graph(spark, codes, dims, most["n"])
    longest = nodes.orderBy(length.desc(), "node").limit(LONGEST).select(F.col("node").alias("v"))
    asked = d.filter(is_query(F.col("id"))).select("id", "key").distinct()
    asked = stage(spark, asked.join(nodes.select("key", "node"), "key").select("id", "node").distinct(), "nn-asked")
    queries = asked.select(F.col("node").alias("q")).distinct()
    queries = queries.join(codes.select(F.col("node").alias("q"), F.col("code").alias("qcode")), "q")
    found = search_graph(spark, graph, codes, stage(spark, queries, "nn-queries"), longest, dims)

    vectors = nodes.select("node", "x")
    exact = found.join(vectors.select(F.col("node").alias("q"), F.col("x").alias("qx")), "q")
    exact = exact.join(vectors.withColumnRenamed("node", "v"), "v")
    dot = F.aggregate(F.zip_with("qx", "x", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    exact = _top(exact.select("q", "v", dot.alias("score")), "q", "score", top + 1, F.col("v"))
    members = d.join(nodes.select("key", "node"), "key").select(F.col("node").alias("v"), "id").distinct()
    members = members.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= top + 1)
    near = exact.join(members.drop("r"), "v").select("q", F.col("id").alias("vec_id"), "score")
    near = asked.withColumnRenamed("id", "query_id").withColumnRenamed("node", "q").join(near, "q")
    near = near.filter(F.col("query_id") != F.col("vec_id"))
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    near = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return near.select("query_id", "rank", "vec_id", "score")
