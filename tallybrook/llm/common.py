"""Shared pieces of the corpus operators."""

from pyspark.sql import functions as F

from ..session import new_folder

# Fixed value: a word is a run of anything but these six white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


_written = []  # folders of this process, oldest first


def stage(spark, df, name):
    """Write `df` to the shared folder and read it back: cuts the lineage, and a lost
    executor costs a re-read instead of the work before it."""
    path = new_folder(spark, name)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark, folders):
    """Delete staged tables that nothing reads any more."""
    for path in folders:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _written.remove(path)


def staged():
    """Folders of the staged tables that have not been released."""
    return list(_written)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text):
    """Array of the words of a text; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def salted_join(left, right, keys, salt_by, salts=32):
    """Left join of a large frame with one row per key, null keys matching null keys.

    A key may hold any share of the left rows, so its rows are spread over `salts`
    values and the right rows repeated for each of them. Nothing is broadcast by hand.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    spread = left.withColumn("__salt", F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int"))
    copies = right.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)],
        *[c for c in right.columns if c not in keys],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt_r"),
    )
    on = F.col("__salt") == F.col("__salt_r")
    for k, n in zip(keys, names):
        on = on & F.col(k).eqNullSafe(F.col(n))
    return spread.join(copies, on, "left").drop("__salt", "__salt_r", *names)
