"""Keeping joins even when one key holds a large part of the rows.

Joins between two shuffled inputs are left to adaptive execution, which splits an
oversized partition by itself. It cannot do so when one side comes straight out of
an aggregation; ``join_to_unique`` covers that case.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS_CONF = "spark.tenderline.hotKeyRows"
HOT_ROWS_DEFAULT = 5_000_000
MAX_HOT_KEYS = 1_000_000
SEEN_AT_FLOOR = 1000
ROWS_PER_TASK = 250_000
SALTS = 64

LOOKUP_MAX_ROWS = 500_000
LOOKUP_MAX_BYTES = 64 * 1024 * 1024


def key_code(keys: Sequence[str | Column]) -> Column:
    """A never-NULL number for a key, NULL keys included."""
    return F.xxhash64(*keys)


def hot_codes(df: DataFrame, keys: Sequence[str | Column], rows: int | None = None) -> list[int]:
    """Codes of the keys that hold more rows than one task should take.

    An input with no more rows than the floor cannot have such a key; counting it
    reads no columns of a file table. Beyond that, the codes of a sample are counted,
    reduced in the map tasks: as many rows as it takes to see a thousand of a key at the
    floor. Every key above the floor is reported whatever the size of the input; there are
    at most rows / floor of them, and never more than the MAX_HOT_KEYS most frequent. It
    decides how the work is spread; results do not depend on it. ``rows`` is their number if
    known already.
    """
    floor = int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))
    if (df.count() if rows is None else rows) <= floor:
        return []
    looked_at = df.select(key_code(keys).alias("code"))
    if floor > SEEN_AT_FLOOR:
        looked_at = looked_at.sample(SEEN_AT_FLOOR / floor, seed=17)
    counts = looked_at.groupBy("code").count().where(F.col("count") > min(floor, SEEN_AT_FLOOR))
    found = counts.orderBy(F.desc("count"), "code").limit(MAX_HOT_KEYS).select("code").toArrow()
    return sorted(found.column(0).to_pylist())


def is_hot(keys: Sequence[str | Column], codes: list[int]) -> Column:
    return key_code(keys).isin(codes) if codes else F.lit(False)


def by_shares(df: DataFrame, rows: int, *by: str | Column) -> DataFrame:
    """The frame placed by columns, into a share for each ROWS_PER_TASK of ``rows``.

    Their number is said, since adaptive execution would otherwise merge shares until there are about as
    many as cores: a task would then take a part of all rows, however many there are. Inputs of one share
    are left to it. Frames placed with the same ``rows`` can be joined without being placed again.
    """
    shares = -(-rows // ROWS_PER_TASK)
    return df.repartition(shares, *by) if shares > 1 else df.repartition(*by)


def placed(df: DataFrame, key: str, others: Sequence[str], rows: int, codes: list[int]) -> DataFrame:
    """Rows placed by a key, those of hot keys by their other columns too.

    For a grouping that sorts its input, as all do that keep texts: what a task sorts is
    then a share of the rows, however few tasks read them and whatever these unfold.
    """
    by = [F.col(key)]
    if codes:
        salt = F.pmod(F.xxhash64(*others), F.lit(SALTS))
        by.append(F.when(is_hot([key], codes), salt).otherwise(0))
    return by_shares(df, rows, *by)


def join_to_unique(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "left",
    codes: list[int] | None = None,
) -> DataFrame:
    """Join many rows to at most one row per key (``right`` is grouped by ``keys``).

    Rows of hot keys skip the shuffle: ``right`` keeps one row per key, so its part
    for the hot keys is bounded by their number; it is measured and broadcast if its bytes
    allow it too. All other rows take the ordinary join. ``codes`` are the hot keys if
    known already.
    """
    if codes is None:
        codes = hot_codes(left, keys)
    if not codes:
        return left.join(right, keys, how)
    hot = is_hot(keys, codes)
    few = right.where(hot)
    if not small_enough(few):
        return left.join(right, keys, how)
    few = F.broadcast(few)
    return left.where(~hot).join(right, keys, how).unionByName(
        left.where(hot).join(few, keys, how)
    )


def _row_bytes(df: DataFrame) -> Column:
    """Sixteen bytes per field, and the text itself."""
    size = F.lit(0)
    for field in df.schema.fields:
        if field.dataType.simpleString() in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        size = size + 16
    return size


def broadcast_by_spark(df: DataFrame) -> bool:
    """Spark's own estimate is below the limit under which it broadcasts by itself.

    A client without the planner at hand does not know, and measures.
    """
    if not hasattr(df, "_jdf"):
        return False
    planned = df._jdf.queryExecution()
    limit = planned.sparkSession().sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(planned.optimizedPlan().stats().sizeInBytes())) <= limit


def small_enough(df: DataFrame) -> bool:
    """Measure a lookup side before broadcasting it: one aggregate, one row back."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df).cast("long")).alias("bytes")
    ).first()
    return row["rows"] <= LOOKUP_MAX_ROWS and (row["bytes"] or 0) <= LOOKUP_MAX_BYTES


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    distinct: bool = False,
) -> DataFrame:
    """Join to a definition table: broadcast if small, else shuffled.

    Where Spark knows the size of the table and broadcasts it anyway, nothing is done.
    Otherwise, as for every JDBC table, it is measured. Beyond the bound both sides are
    plain shuffles, which adaptive execution splits. With ``distinct`` copies of lookup
    rows count once; the bound is checked with them.
    """
    side = lookup.distinct() if distinct else lookup
    if broadcast_by_spark(lookup) or not small_enough(lookup):
        return left.join(side, keys, how)
    return left.join(F.broadcast(side), keys, how)
