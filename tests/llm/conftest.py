import pytest


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory):
    """Documents with every awkward case: nulls in each column, empty texts, repeated rows,
    a very long text, ties, and extra columns whose names operators use inside."""
    long = " ".join(f"word{i % 977} other{i % 1013}" for i in range(60_000))
    base = " ".join(f"alpha{i} beta{i}" for i in range(80))
    near = base.replace("alpha40", "gamma40")
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, near, "en", None),
        (4, None, "en", "b"),
        (5, "", None, "b"),
        (6, "   \n\t ", "de", "b"),
        (None, base, "en", "a"),
        (7, long, "fr", "c"),
        (8, "one", "fr", "c"),
        (9, "mail bob@site.example.com or +1 (212) 555-0199, ip 10.1.2.3.", "en", "c"),
    ]
    rows = [(*r, 7, "x", [1], 0.5, "t", 1) for r in rows]
    frame = spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_words int, key string,"
        " spans array<int>, score double, size string, id int",
    )
    folder = str(tmp_path_factory.mktemp("messy") / "documents.parquet")
    frame.write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.filter("false")
