"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is cut into blocks of BLOCK turns; a block is one row with a column pair (128 bits
of hash) per turn. One ROLLUP over these columns makes a group of every prefix, and the grouping
id tells its depth. Longer conversations go on in further blocks, whose groups are keyed by the
node that the block before ended in, so that all blocks of all conversations are in one ROLLUP.

What a node needs of its whole subtree is counted where it arises and then only summed over
members. Every node stands for itself in one of its members, the one with the smallest id: a first
ROLLUP finds these, each conversation adds up what its own nodes are worth from every depth on,
and a second ROLLUP sums this over the members. So no round per level is needed and nothing is
joined along a path.

No step holds a conversation, a node's members or a node's children in one task: numbers and
running sums are carried from block to block, groups are combined before the shuffle, and ids of
a node's members are joined to texts in pieces.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import stage, words

# Fixed values.
BLOCK = 8  # turns to a block: columns of the ROLLUP
SPAN = 4096  # blocks of a conversation that are scanned in one task
PIECE = 100_000  # ids in one piece of a member list

SLOTS = range(1, BLOCK + 1)
NODE = ["depth", "a", "b"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def number_turns(spark, conversations):
    """`conv_id`, `pos` (from 1), `t`, `u` (turn id: two hashes of role and text), `n_words`,
    `n_turns` (of the conversation), `part`.

    Turns are ordered by `turn`, null first; rows of equal turn by the MD5 of role and text, so that
    the order of tied rows is the same in every run. A null role or text counts as empty. Rows
    with a null `conv_id` belong to no conversation and are left out. Other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t"),
        F.xxhash64(F.lit(2), role, text).alias("u"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("tie"),
        F.size(words(F.col("text"))).cast("bigint").alias("n_words"),
    )
    # a conversation of any length is spread over ranges; a range continues the count of those before
    dealt = turns.repartitionByRange("conv_id", "turn", "tie").withColumn("part", F.spark_partition_id())
    dealt = stage(spark, dealt, "trie-turns")
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    cells = dealt.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select(
        "conv_id",
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("n_turns"),
    )
    within = Window.partitionBy("conv_id", "part").orderBy("turn", "tie")
    numbered = dealt.join(cells, ["conv_id", "part"]).select(
        "conv_id",
        (F.col("before") + F.row_number().over(within)).alias("pos"),
        "t",
        "u",
        "n_words",
        "n_turns",
        "part",
    )
    return stage(spark, numbered, "trie-numbered")


def with_shared_openings(numbered, every=20, most=4):
    """Rebuilt turns: conversation c opens with the first h turns of c - c % `every` (all if
    fewer, none if absent) and goes on with its own after the first h; h = crc32(c) % `most`.

    Same columns as `number_turns` without `part`; a conversation left without turns has one row of
    null `pos`.
    """
    convs = numbered.filter("pos = 1").select("conv_id", "n_turns")
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    taken = F.least("h", F.coalesce("base_turns", F.lit(0)))
    convs = convs.join(bases, "base", "left").select(
        "conv_id",
        "base",
        "h",
        taken.alias("taken"),
        (taken + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))).alias("n_turns"),
    )
    openings = numbered.filter(F.col("pos") < most)
    openings = openings.select(F.col("conv_id").alias("base"), "pos", "t", "u", "n_words")
    opened = convs.join(openings, "base").filter("pos <= taken")
    # one row per conversation and part meets the turns: a long conversation stays spread out
    cells = numbered.groupBy("conv_id", "part").agg(F.max("pos").alias("last"))
    cells = cells.join(convs, "conv_id").filter("last > h").select("conv_id", "part", "h", "taken", "n_turns")
    own = numbered.drop("n_turns").join(cells, ["conv_id", "part"]).filter("pos > h")
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    bare = convs.filter("n_turns = 0").select(
        "conv_id", *[F.lit(None).cast("bigint").alias(c) for c in ("pos", "t", "u", "n_words")], "n_turns"
    )
    columns = bare.columns
    return opened.select(*columns).unionByName(own.select(*columns)).unionByName(bare)


def _carried(rows, folds, later=False):
    """Adds one column per entry of `folds` (name: (value, aggregate, combine)): the aggregate
    over all blocks of the conversation before this one, or after it. Scanned in spans of
    SPAN blocks, whose own aggregates are scanned first."""
    span = F.floor(F.col("block") / SPAN).cast("int")
    rows = rows.withColumn("span", span)

    def over(window, column):
        column = F.col(column)
        return window.orderBy(column.desc() if later else column).rowsBetween(Window.unboundedPreceding, -1)

    heads = rows.groupBy("conv_id", "span").agg(*[f(v).alias(f"{k}_s") for k, (v, f, _) in folds.items()])
    outer = over(Window.partitionBy("conv_id"), "span")
    heads = heads.select("conv_id", "span", *[f(f"{k}_s").over(outer).alias(f"{k}_o") for k, (_, f, _) in folds.items()])
    inner = over(Window.partitionBy("conv_id", "span"), "block")
    zero = F.lit(0).cast("bigint")
    found = {
        k: combine(F.coalesce(f(v).over(inner), zero), F.coalesce(f"{k}_o", zero))
        for k, (v, f, combine) in folds.items()
    }
    return rows.join(heads, ["conv_id", "span"]).select(
        *[c for c in rows.columns if c != "span"], *[v.alias(k) for k, v in found.items()]
    )


def _xor(x, y):
    return x.bitwiseXOR(y)


def _mark(side, slot):
    """Hash of a turn at its place; the marks of a prefix, exclusive-ored, name its node."""
    at = F.col("block").cast("bigint") * BLOCK + slot
    value = F.xxhash64(F.lit(3 + side), at, F.col(f"p{slot}"), F.col(f"q{slot}"))
    return F.when(F.col(f"p{slot}").isNull(), F.lit(0).cast("bigint")).otherwise(value)


def _marks(side, upto=BLOCK):
    total = F.lit(0).cast("bigint")
    for slot in range(1, upto + 1):
        total = _xor(total, _mark(side, slot))
    return total


def _blocks(spark, turns):
    """One row per conversation and block: columns p1, q1 .. (null after the last turn),
    w1 .. (words), n_turns, and the node (a, b) that the blocks before end in."""
    slot, block = (F.col("pos") - 1) % BLOCK + 1, F.expr(f"cast((pos - 1) div {BLOCK} as int)")
    cells = turns.select("*", slot.alias("slot"), F.coalesce(block, F.lit(0)).alias("block"))
    values = [("p", "t"), ("q", "u"), ("w", "n_words")]
    wide = cells.groupBy("conv_id", "block").agg(
        F.max("n_turns").alias("n_turns"),
        *[F.max(F.when(F.col("slot") == i, F.col(c))).alias(f"{k}{i}") for i in SLOTS for k, c in values],
    )
    wide = stage(spark, wide, "trie-wide")
    folds = {name: (_marks(side), F.bit_xor, _xor) for side, name in enumerate("ab")}
    return stage(spark, _carried(wide, folds), "trie-blocks")


def _rollup(spark, rows, *measures):
    """One row per prefix: block, a, b, p1 .. q8, `level` (turns of it in the block) and the
    measures. Groups that end in a place without a turn are no prefixes and go."""
    pairs = ", ".join(f"(p{i}, q{i})" for i in SLOTS)
    names = ", ".join(f"p{i}, q{i}" for i in SLOTS)
    groups = spark.sql(
        f"SELECT block, a, b, {names}, CAST({BLOCK} - bit_count(grouping_id()) / 2 AS INT) AS level,"
        f" {', '.join(measures)} FROM {{rows}} GROUP BY block, a, b, ROLLUP({pairs})",
        rows=rows,
    )
    last = F.get(F.array(*[F.col(f"p{i}") for i in SLOTS]), F.col("level") - 1)
    root = (F.col("level") == 0) & (F.col("block") == 0)
    return groups.filter(root | (F.col("level") > 0) & last.isNotNull())


def _own_worth(spark, rows):
    """Adds to each block what the nodes that stand in this conversation are worth from each
    slot on, later blocks included (x1 ..), and the leaves that stand in it (`leaf`)."""
    nodes = _rollup(spark, rows, "min(conv_id) AS conv_id", "count(*) AS n", "max(n_turns) AS deepest")
    nodes = nodes.withColumn("leaf", F.col("deepest") == F.col("block").cast("bigint") * BLOCK + F.col("level"))
    nodes = nodes.filter("leaf or n > 1").groupBy("conv_id", "block").agg(
        F.max(F.col("leaf").cast("bigint")).alias("own_leaf"),
        *[F.max(F.when(F.col("level") == i, F.col("n") - 1)).alias(f"c{i}") for i in SLOTS],
    )
    met = rows.join(nodes, ["conv_id", "block"], "left")
    zero = F.lit(0).cast("bigint")
    total = zero
    for i in reversed(SLOTS):
        total = total + F.coalesce(F.col(f"c{i}") * F.col(f"w{i}"), zero)
        met = met.withColumn(f"g{i}", total)
    met = met.withColumn("own_leaf", F.coalesce("own_leaf", zero))
    met = met.drop(*[f"{k}{i}" for i in SLOTS for k in "cw"])
    folds = {
        "later": (F.col("g1"), F.sum, lambda x, y: x + y),
        "later_leaf": (F.col("own_leaf"), F.sum, lambda x, y: x + y),
    }
    worth = _carried(stage(spark, met, "trie-met"), folds, later=True)
    return worth.select(
        "conv_id",
        "block",
        "a",
        "b",
        *[f"{k}{i}" for i in SLOTS for k in "pq"],
        *[(F.col(f"g{i}") + F.col("later")).alias(f"x{i}") for i in SLOTS],
        (F.col("own_leaf") + F.col("later_leaf")).alias("leaf"),
    )


def _named(groups):
    """Adds the node (depth, a, b) of each prefix and its parent's (pa, pb)."""

    def upto(side, name, less):
        steps = [_marks(side, max(0, level - less)) for level in range(BLOCK + 1)]
        return _xor(F.col(name), F.get(F.array(*steps), F.col("level")))

    depth = F.col("block").cast("bigint") * BLOCK + F.col("level")
    values = {"depth": depth}
    for side, name in enumerate("ab"):
        values[f"__{name}"] = upto(side, name, 0)
        values[f"p{name}"] = upto(side, name, 1)
    named = groups.withColumns(values)
    return named.drop("a", "b").withColumnsRenamed({"__a": "a", "__b": "b"})


def member_digests(spark, ends):
    """SHA-256 of the decimal ids, ascending and comma-joined, per node of `ends` (depth, a, b,
    conv_id). The ids are sorted and joined to pieces range by range; one task hashes the
    pieces of a node in order and holds one of them at a time."""
    sorted_ends = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def join(frames):
        for f in frames:
            nodes, ids = f[NODE].to_numpy(), f["conv_id"].tolist()
            bounds = np.flatnonzero((nodes[1:] != nodes[:-1]).any(axis=1)) + 1
            rows = []
            for low, high in zip([0, *bounds.tolist()], [*bounds.tolist(), len(ids)]):
                for at in range(low, high, PIECE):
                    part = ids[at : min(at + PIECE, high)]
                    rows.append((*nodes[low].tolist(), part[0], ",".join(map(str, part))))
            yield pd.DataFrame(rows, columns=[*NODE, "first", "ids"])

    pieces = sorted_ends.mapInPandas(join, "depth bigint, a bigint, b bigint, first bigint, ids string")
    pieces = stage(spark, pieces, "trie-pieces")
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digest(frames):
        node, state = None, None
        for f in frames:
            rows = []
            for *key, _, ids in f.itertuples(index=False, name=None):
                if key != node:
                    if node is not None:
                        rows.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(rows, columns=[*NODE, "ends_sha256"])
        if node is not None:
            yield pd.DataFrame([(*node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    return pieces.mapInPandas(digest, "depth bigint, a bigint, b bigint, ends_sha256 string")


def prefix_trie(spark, turns):
    """One row per distinct prefix of the conversations in `turns` (conv_id, pos from 1 without
    gaps, t, u, n_words, n_turns; a turnless conversation has one row of null `pos`).

    Returns `conv_id` (the smallest member), `depth`, `parent_conv_id` (root: null), `n_convs`,
    `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`, and the node's hash `a`, `b`. No
    conversations: no rows.
    """
    rows = _blocks(spark, turns)
    sums = [f"sum(x{i}) AS x{i}" for i in SLOTS]
    groups = _rollup(
        spark, _own_worth(spark, rows), "min(conv_id) AS conv_id", "count(*) AS n_convs", "sum(leaf) AS n_leaves", *sums
    )
    saved = F.get(F.array(*[F.col(f"x{i}") for i in SLOTS]), F.greatest(F.col("level") - 1, F.lit(0)))
    nodes = _named(groups).select(*NODE, "pa", "pb", "conv_id", "n_convs", "n_leaves", saved.alias("saved_tokens"))
    nodes = stage(spark, nodes, "trie-nodes")

    up = [(F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")]
    children = nodes.filter("depth > 0").select(*up).groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_children"))
    # many children of one parent are split by the skew join: nothing is aggregated beside it
    parents = nodes.join(children, NODE, "left").select(*NODE, "conv_id", "n_children")
    parents = stage(spark, parents, "trie-parents")
    above = parents.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("a").alias("pa"),
        F.col("b").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    placed = stage(spark, nodes.join(above, ["depth", "pa", "pb"], "left"), "trie-placed")

    tail = F.col("block") == F.greatest(F.expr(f"(n_turns - 1) div {BLOCK}"), F.lit(0))
    ends = rows.filter(tail).select(
        F.col("n_turns").alias("depth"),
        *[_xor(F.col(n), _marks(side)).alias(n) for side, n in enumerate("ab")],
        "conv_id",
    )
    done = placed.join(parents.select(*NODE, "n_children"), NODE)
    done = done.join(member_digests(spark, ends), NODE, "left")
    zero = F.lit(0).cast("bigint")
    return done.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
        "a",
        "b",
    )


# DuckDB: paths as lists of digests, every ancestor of every node by its list prefix.
TRIE_SQL = r"""
WITH RECURSIVE polynomial AS (
    SELECT range AS byte, range AS c, 0 AS step FROM range(256)
    UNION ALL
    SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, step + 1
    FROM polynomial WHERE step < 8
), crc_table AS (
    SELECT list(c ORDER BY byte) AS crcs FROM polynomial WHERE step = 8
), numbered AS (
    SELECT conv_id, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), turns AS (
    SELECT conv_id, pos, md5(length(role) || ':' || role || text) AS id,
           len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words
    FROM numbered
), opened AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base,
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: xor(crc // 256, crcs[xor(crc, byte) % 256 + 1])), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc_table
), rebuilt AS (
    SELECT o.conv_id, 0 AS part, t.pos, t.id, t.n_words FROM opened o JOIN turns t ON t.conv_id = o.base AND t.pos <= o.h
    UNION ALL
    SELECT o.conv_id, 1, t.pos, t.id, t.n_words FROM opened o JOIN turns t ON t.conv_id = o.conv_id AND t.pos > o.h
), paths AS (
    SELECT o.conv_id, coalesce(list(r.id ORDER BY r.part, r.pos) FILTER (r.id IS NOT NULL), []) AS path,
           coalesce(list(r.n_words ORDER BY r.part, r.pos) FILTER (r.id IS NOT NULL), []) AS sizes
    FROM opened o LEFT JOIN rebuilt r ON r.conv_id = o.conv_id GROUP BY o.conv_id
), prefixes AS (
    SELECT conv_id, d AS depth, len(path) AS n, array_to_string(path[1:d], ',') AS node,
           CASE WHEN d > 0 THEN array_to_string(path[1:d - 1], ',') END AS parent,
           CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS n_words
    FROM paths, unnest(range(len(path) + 1)) AS depths(d)
), nodes AS (
    SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           any_value(n_words) AS n_words, max(n) = depth AS leaf,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, node
), worth AS (
    SELECT p.depth, p.node, sum((v.n_convs - 1) * v.n_words) AS saved_tokens, sum(v.leaf::INT) AS n_leaves
    FROM nodes v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.depth, p.node
), children AS (
    SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
)
SELECT n.conv_id::BIGINT AS conv_id, n.depth::BIGINT AS depth, p.conv_id::BIGINT AS parent_conv_id,
       n.n_convs::BIGINT AS n_convs, coalesce(c.n_children, 0)::BIGINT AS n_children,
       w.n_leaves::BIGINT AS n_leaves, w.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN worth w USING (depth, node) LEFT JOIN children c USING (depth, node)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.node = n.parent
"""
