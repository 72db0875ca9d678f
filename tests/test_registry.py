"""Wire prefix and registry audits."""

from tallybrook.functions.wire import split_wire_prefix
from tallybrook.operators import registry
from tallybrook.suite.queries import all_queries
from tests.helpers import rows


def raw(spark, *values):
    return spark.createDataFrame(
        [(i, bytearray.fromhex(v) if v is not None else None) for i, v in enumerate(values)],
        "offset bigint, value binary",
    )


def test_prefix(spark):
    frame = raw(spark, "000000001206626F62", "0100000012AA", "0000", "0000000012", "00FFFFFFFF01", None)
    out = split_wire_prefix(frame).orderBy("offset").collect()
    assert (out[0].magic, out[0].schema_id, bytes(out[0].payload).hex()) == (0, 18, "06626f62")
    assert (out[1].magic, out[1].schema_id, out[1].wire_error) == (1, None, "bad_magic")
    assert (out[2].schema_id, out[2].wire_error) == (None, "short_prefix")
    assert (out[3].schema_id, bytes(out[3].payload), out[3].wire_error) == (18, b"", None)
    assert out[4].schema_id == 4294967295
    assert (out[5].schema_id, out[5].wire_error) == (None, None)


def dump(spark, data):
    return spark.createDataFrame(
        data,
        "subject string, version int, global_id bigint, content_id bigint, field string,"
        "has_default boolean",
    )


def test_id_audits(spark):
    entries = dump(
        spark,
        [
            ("windows-key", 1, 18, 17, "customerId", False),
            ("windows-value", 1, 19, 18, "customerId", False),
            ("orders-value", 1, 1, 1, "orderId", False),
        ],
    )
    records = raw(spark, "0000000012AA", "0000000012BB", "000000000BCC", "0000000001DD")
    assert rows(registry.dangling_schema_ids(records, entries)) == [(11, 1)]
    assert rows(registry.ambiguous_schema_ids(records, entries)) == [
        (18, "windows-key", "windows-value", 2)
    ]


def test_every_subject_of_an_ambiguous_id(spark):
    entries = dump(
        spark,
        [("A", 1, 7, 70, "x", False), ("D", 1, 7, 7, "x", False)]
        + [(s, 1, 100 + i, 7, "x", False) for i, s in enumerate("BC")],
    )
    found = rows(registry.ambiguous_schema_ids(raw(spark, "0000000007AA"), entries))
    assert sorted(found) == [(7, "A", "B", 1), (7, "A", "C", 1), (7, "A", "D", 1)]


def version(subject, number, **fields):
    return [(subject, number, number, number, f, default) for f, default in fields.items()]


def test_rename_breaks_both_directions(spark):
    entries = dump(
        spark,
        version("orders", 1, orderId=False, customerId=False, currency=True)
        + version("orders", 2, id=False, customerId=False, currency=True)
        + version("safe", 1, a=False)
        + version("safe", 2, a=False, b=True),
    )
    assert sorted(rows(registry.schema_compat_diff(entries), "subject", "field", "direction")) == [
        ("orders", "id", "backward"),
        ("orders", "orderId", "forward"),
    ]


def test_versions_compare_with_the_one_before(spark):
    entries = dump(
        spark,
        version("s", 1, a=False)
        + version("s", 4, a=False, b=False)
        + version("s", 7, a=False, b=False),
    )
    for limits in ({}, {"hot_rows": 1, "block_rows": 2}):
        out = registry.schema_compat_diff(entries, **limits)
        assert rows(out) == [("s", 1, 4, "b", "backward")]


def test_versions_are_not_broadcast(spark, sf_dir):
    """Rows out of an explode are many more than the planner expects."""
    plan = all_queries()["schema_compat_diff"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
