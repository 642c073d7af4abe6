"""Running totals along the ordered rows of a key, without a task per key.

A window over a key puts all its rows into one task. For the few keys too large for
that, rows are dealt by ranges of (key, order) into partitions of about equal size, whatever
the rows look like: all in one second, or without a date. The part of a key in one partition
is a slot. Totals run inside a slot; an exclusive scan over the sums of a key's slots gives
what to carry in. There are at most as many slots as partitions and hot keys together. All
other keys have a single slot and need neither the table nor the join.

Where there are hot keys, rows are collapsed to distinct rows with a number of copies
beforehand, so copies of one row, which no range can part, weigh as much as a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tenderline.operators.balance import hot_codes, is_hot
from tenderline.sources.stores import staged

SLOT = "slot"
CHUNK = 65_536


def collapsed(
    df: DataFrame, columns: list[str], key: str, codes: list[int], copies: str = "copies",
    spread: bool = False,
) -> DataFrame:
    """Distinct rows and how often each occurs.

    Without hot keys the rows are placed by ``key`` right away, and the join or
    window on it that follows needs no further shuffle. With hot keys map tasks
    reduce their rows first and the groups are spread over all columns.

    Grouping takes -0.0 for 0.0, so floating columns are grouped by their text and
    brought along as they are.
    """
    placed = df if codes or spread else df.repartition(key)
    texts = floating(df, columns)
    keys = [F.col(c).cast("string").alias(f"text of {c}") if c in texts else F.col(c) for c in columns]
    grouped = placed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(copies), *[F.first(c).alias(c) for c in texts]
    )
    return grouped.select(*columns, copies)


def with_copies(
    df: DataFrame, columns: list[str], codes: list[int], copies: str = "copies"
) -> DataFrame:
    """Rows with a number of copies: collapsed for hot keys, else all rows, once each."""
    if codes:
        return collapsed(df, columns, columns[0], codes, copies)
    return df.select(*columns, F.lit(1).cast("long").alias(copies))


def with_slot(df: DataFrame, key: str, order: list[str], codes: list[int]) -> DataFrame:
    """NULL slot for ordinary keys; for hot ones the number of the range that a row falls into.

    Ranges are over the key and then ``order``, unknown values last, so the slots of a key
    are in that order and rows that tie share one. Their bounds come from a sample and would differ in
    another run of the plan, so the rows of hot keys are staged with their slots.
    """
    alone = df.withColumn(SLOT, F.lit(None).cast("int"))
    if not codes:
        return alone
    hot = is_hot([key], codes)
    many = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = [F.asc_nulls_last(key), *[F.asc_nulls_last(c) for c in order]]
    dealt = df.where(hot).repartitionByRange(many, *by).withColumn(SLOT, F.spark_partition_id())
    return alone.where(~hot).unionByName(staged(dealt))


def floating(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if df.schema[c].dataType.typeName() in ("float", "double")]


def in_order(key: str, order: list[str]) -> WindowSpec:
    return Window.partitionBy(key, SLOT).orderBy(*[F.asc_nulls_last(c) for c in order])


def whole(spec: WindowSpec) -> WindowSpec:
    """All rows of the slot, on the sort that ``spec`` asks for anyway."""
    return spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def slot_sums(df: DataFrame, key: str, value: Column, codes: list[int]) -> DataFrame:
    """Per slot of a hot key: the sum over earlier and over later slots.

    The condition is on the key itself, so that it reaches the inputs and only the
    rows of hot keys are computed a second time.
    """
    here = F.coalesce(F.sum(value), F.lit(0))
    sums = df.where(is_hot([key], codes)).groupBy(key, SLOT).agg(here.alias("here"))
    along = Window.partitionBy(key).orderBy(SLOT)
    so_far = F.sum("here").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return sums.select(
        key,
        SLOT,
        (so_far - F.col("here")).alias("earlier"),
        (F.sum("here").over(whole(along)) - so_far).alias("later"),
    )


def join_slots(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Look up the slot of a row; an unknown key is a key like any other."""
    named = table.withColumnsRenamed({key: "slot_key", SLOT: "slot_number"})
    same = F.col(key).eqNullSafe(F.col("slot_key")) & (F.col(SLOT) == F.col("slot_number"))
    return df.join(named, same, "left").drop("slot_key", "slot_number")


def total_before(
    df: DataFrame, key: str, order: list[str], value: str, out: str, codes: list[int]
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows that come before in the key."""
    ahead = in_order(key, order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(value).over(ahead), F.lit(0))
    if not codes:
        return df.withColumn(out, local)
    offsets = slot_sums(df, key, F.col(value), codes).drop("later")
    return (
        join_slots(df.withColumn(out, local), offsets, key)
        .withColumn(out, F.col(out) + F.coalesce("earlier", F.lit(0)))
        .drop("earlier")
    )


def _chunked(df: DataFrame, times: str) -> DataFrame:
    return df.select("*", F.expr(f"explode(sequence(0L, ({times} - 1) div {CHUNK})) AS chunk"))


def _unrolled(chunks: DataFrame, times: str, index: str) -> DataFrame:
    start = F.col("chunk") * CHUNK
    return chunks.select(
        *[c for c in chunks.columns if c != "chunk"],
        F.explode(F.sequence(start + 1, F.least(start + CHUNK, F.col(times)))).alias(index),
    )


def unroll(df: DataFrame, codes: list[int], times: str = "copies", index: str = "copy") -> DataFrame:
    """Undo ``with_copies``: one row per copy."""
    if codes:
        return repeat_rows(df, times, index, spread=True)
    return df.withColumn(index, F.lit(1))


def repeat_rows(df: DataFrame, times: str, index: str, spread: bool = False) -> DataFrame:
    """Each row ``times`` times, numbered from 1.

    Unrolled in two steps of at most CHUNK rows, so a very frequent row does not have
    to hold all its numbers in one array. With ``spread`` its chunks go to different
    tasks in between.
    """
    chunks = _chunked(df, times)
    if spread:
        chunks = chunks.repartition(*[F.col(c) for c in chunks.columns])
    return _unrolled(chunks, times, index)


def sort_rows(df: DataFrame, order: list[str], many_copies: bool = False) -> DataFrame:
    """All rows in a total order, unknown values last.

    Equal rows cannot be separated by a range of values. With ``many_copies`` very
    frequent rows are looked for, in a pass over all columns, and sorted as chunks of
    copies, which can.
    """
    by = [F.asc_nulls_last(c) for c in order] + [F.col(c).cast("string") for c in floating(df, order)]
    codes = hot_codes(df, df.columns) if many_copies else []
    if not codes:
        return df.orderBy(*by)
    columns = df.columns
    chunks = _chunked(with_copies(df, columns, codes), "copies")
    return _unrolled(chunks.orderBy(*by, "chunk"), "copies", "copy").select(*columns)
