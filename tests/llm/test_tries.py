"""The prefix trie against SQL, against a plain Python trie, and on awkward rows."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tallybrook.llm import prefix_trie as pt
from tallybrook.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, a string, block int, x1 double"


def plain(rows, rebuild=True):
    """Rows (conv_id, turn, role, text) to the expected node rows."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, tie, role, text))
    convs = {c: [t[3:] for t in sorted(ts)] for c, ts in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        built[c] = (convs.get(c - c % 20, [])[:h] if rebuild else []) + own[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, worth, leaves = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, own in members.items():
        gain = (len(own) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            worth[node[:d]] += gain
            leaves[node[:d]] += not children[node]
    result = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(node))
        digest = hashlib.sha256(ends.encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        result.append((min(own), len(node), parent, len(own), children[node], leaves[node], worth[node], digest))
    return sorted(result, key=str)


def trie(spark, frame):
    numbered = pt.number_turns(spark, frame)
    return sorted((tuple(r) for r in pt.prefix_trie(spark, pt.with_shared_openings(numbered)).select(*COLUMNS).collect()), key=str)


def test_query_equals_sql_and_plain(spark, sf_dir):
    got = queries.op11_prefix_trie(spark, sf_dir)
    path = os.path.join(sf_dir, "conversations.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{path}'")
    wanted = con.execute(pt.TRIE_SQL).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    rows = sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str)
    expected = plain(con.execute("select conv_id, turn, role, text from conversations").fetchall())
    assert rows == expected
    sql = con.execute(f"select {', '.join(COLUMNS)} from ({pt.TRIE_SQL.strip()})").fetchall()
    assert sorted(sql, key=str) == expected


def awkward():
    rows = []
    # ids 0..45 share openings; some have no turns of their own after the first three
    for c in range(46):
        if c == 20:
            continue
        for t in range(c % 6 + 1):
            rows.append((c, t if t else None, "user", f"word {'x ' * (t % 3)}{c % 2 if t > 3 else ''}"))
    rows += [(7, 2, None, None), (7, 2, "", ""), (7, 2, "user", "word"), (7, 2, "user", "word")]
    rows += [(None, 1, "user", "lost"), (60, None, None, None), (60, None, "a", None), (61, 5, "a", "")]
    # longer than several blocks, equal up to a point, one the beginning of another
    for c, n in ((100, 45), (101, 45), (102, 16), (103, 17), (104, 24), (105, 45)):
        for t in range(n):
            rows.append((c, t, "user", "one two three" if c != 105 or t != 30 else "another"))
    rows += [(c, 0, "user", "only") for c in (200, 220, 221, 222, 223, 224)]
    rows += [(300, 0, "user", "long " * 50_000)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("conversations") / "c")
    data = [(*r, 1, "a", 2, 0.5) for r in awkward()]
    spark.createDataFrame(data, SCHEMA).repartition(5).write.parquet(folder)
    return spark.read.parquet(folder)


def test_awkward_rows(spark, frame):
    got = trie(spark, frame)
    assert got == plain(awkward())
    assert max(r[1] for r in got) == 45


def test_carried_over_spans_and_pieces(spark, frame, monkeypatch):
    """The same answer when a conversation is cut into many spans and lists into many pieces."""
    monkeypatch.setattr(pt, "SPAN", 2)
    monkeypatch.setattr(pt, "PIECE", 2)
    assert trie(spark, frame) == plain(awkward())


def test_all_turnless_and_empty(spark, frame):
    assert trie(spark, frame.filter("false")) == []
    # 1 has h = 3 and no base: nothing is left of it but the root
    c = next(i for i in range(1, 20) if zlib.crc32(str(i).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone")]
    alone = spark.createDataFrame([(*r, 1, "a", 2, 0.5) for r in rows], SCHEMA)
    got = trie(spark, alone)
    assert got == plain(rows) and got[0][:2] == (c, 0) and got[0][5] == 1
