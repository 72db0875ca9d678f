"""Nearest neighbours against brute force, and on awkward rows."""

import numpy as np
import pytest

from tallybrook.llm import neighbours, queries
from tallybrook.llm.common import table


def brute(vectors, asked, top=20):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids])
    result = {}
    for q in asked:
        scores = m @ np.array(vectors[q])
        order = sorted((-s, i) for s, i in zip(scores, ids) if i != q)
        result[q] = [i for _, i in order[:top]]
    return result


def found(df):
    result = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        result.setdefault(r.query_id, []).append(r.vec_id)
    return result


def test_recall(spark, sf_dir):
    vectors = {r.vec_id: [float(x) for x in r.embedding] for r in table(spark, sf_dir, "embeddings").collect()}
    asked = [i for i in vectors if i % 20 == 0]
    want, got = brute(vectors, asked), found(queries.op2_descent_graph(spark, sf_dir))
    assert got.keys() == want.keys()
    assert all(len(got[q]) == len(want[q]) for q in want)
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_awkward_rows(spark, tmp_path):
    same = [0.6, 0.8]
    rows = [(i, same) for i in range(30)]
    rows += [(20, same), (40, [1.0, 0.0]), (41, [0.0, 1.0]), (42, [2.0, 0.5])]
    rows += [(60, None), (80, [0.0, 0.0]), (100, [None, 1.0]), (120, [float("nan"), 1.0])]
    rows += [(140, [float("inf"), 1.0]), (160, [1.0]), (None, same)]
    rows = [(i, v, 0, 1.0, "q") for i, v in rows]
    schema = "vec_id bigint, embedding array<float>, rank int, score double, key string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "e"))
    frame = spark.read.parquet(str(tmp_path / "e"))
    got = found(neighbours.nearest_neighbours(spark, frame, lambda i: i % 20 == 0))
    assert set(got) == {0, 20, 40}
    assert got[40][0] == 42 and got[40][1:] == list(range(19))
    assert got[0][0] == 42 and got[0][1:] == list(range(1, 20))
    assert got[20] == [42, *range(19)]
    assert neighbours.nearest_neighbours(spark, frame.filter("false"), lambda i: i % 20 == 0).count() == 0


@pytest.mark.parametrize("lengths", ["one outlier", "mixed", "far apart"])
def test_recall_with_other_lengths(spark, sf_dir, tmp_path, lengths):
    """One vector of norm 100, norms spread like exp(N(0, 0.7)), and norms between 1e-120 and 1e120."""
    rng = np.random.default_rng(3)
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table(spark, sf_dir, "embeddings").collect()]
    if lengths == "one outlier":
        rows = [(i, x * (100 / np.linalg.norm(x) if i == 7 else 1)) for i, x in rows]
    elif lengths == "mixed":
        rows = [(i, x * np.exp(0.7 * rng.standard_normal())) for i, x in rows]
    else:
        rows = [(i, x * 10.0 ** rng.integers(-120, 121)) for i, x in rows]
    vectors = {i: x.tolist() for i, x in rows}
    frame = spark.createDataFrame(list(vectors.items()), "vec_id bigint, embedding array<double>")
    frame.write.parquet(str(tmp_path / "e"))
    frame = spark.read.parquet(str(tmp_path / "e"))
    asked = [i for i in vectors if i % 20 == 0]
    want = brute(vectors, asked)
    got = found(neighbours.nearest_neighbours(spark, frame, lambda i: i % 20 == 0))
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values())), hits / sum(map(len, want.values()))
