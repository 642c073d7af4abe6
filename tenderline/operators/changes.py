"""What differs between two loads of a table: keyed digests of rows, compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INSERTED, CHANGED, DELETED = "inserted", "changed", "deleted"


def row_digest(df: DataFrame, columns: list[str]) -> list[Column]:
    """Two 64-bit numbers for the content of a row; NULL differs from every value and -0.0 from 0.0."""
    seen: list[Column] = []
    for name in columns:
        value = F.col(name)
        if df.schema[name].dataType.typeName() in ("float", "double"):
            value = value.cast("string")
        seen += [value, value.isNull()]
    return [F.xxhash64(F.lit(seed), *seen) for seed in (1, 2)]


def key_digests(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, rows, d1, d2): how many rows a key has and sums of their digests.

    Sums do not depend on the order of rows and are formed in the map tasks first, so a key with very many rows
    is no burden. NULL is a key like any other.
    """
    d1, d2 = row_digest(df, columns)
    wide = "decimal(38,0)"
    return df.groupBy(F.col(key).alias("key")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(d1.cast(wide)).alias("d1"), F.sum(d2.cast(wide)).alias("d2")
    )


def change_set(before: DataFrame, after: DataFrame) -> DataFrame:
    """(key, change) for the keys whose digests differ between two loads."""
    old = before.select(F.col("key").alias("old_key"), F.struct("rows", "d1", "d2").alias("old"))
    new = after.select("key", F.struct("rows", "d1", "d2").alias("new"))
    both = new.join(old, F.col("key").eqNullSafe(F.col("old_key")), "full")
    change = F.when(F.col("old").isNull(), INSERTED).when(F.col("new").isNull(), DELETED).when(F.col("old") != F.col("new"), CHANGED)
    which = F.when(F.col("new").isNull(), F.col("old_key")).otherwise(F.col("key"))
    return both.select(which.alias("key"), change.alias("change")).where(F.col("change").isNotNull())


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
