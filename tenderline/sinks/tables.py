"""Writing results: replace, append, reload, staged insert, publish, copies.

A frame is executed once per write; row counts are observed on that write.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tenderline.catalog import TRANSFER_PAGE
from tenderline.operators.filters import project
from tenderline.sources.snapshots import SnapshotStore
from tenderline.sources.stores import RangeSlices, Store, count_rows

OVERWRITE = "overwrite"
APPEND = "append"


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def confirmed(rows: int, spark: SparkSession, store: Store, table: str) -> int:
    """Compare the replaced table with the rows written where tasks may repeat rows."""
    if store.may_repeat_rows:
        found = count_rows(store, spark, table)
        if found != rows:
            raise RuntimeError(f"{table} holds {found} rows after writing {rows}; run it again")
    return rows


def overwrite(df: DataFrame, store: Store, table: str) -> int:
    rows = counted(df, lambda d: store.replace(d, table))
    return confirmed(rows, df.sparkSession, store, table)


def append(df: DataFrame, store: Store, table: str, load: str | None = None) -> int:
    """Add rows. Under the name of a ``load`` this can be repeated: the rows of a load are there once."""
    if load is None:
        return counted(df, lambda d: store.append(d, table))
    if not isinstance(store, SnapshotStore):
        raise ValueError(f"{table}: only a store of snapshots keeps a ledger of loads")
    return counted(df, lambda d: store.append(d, table, load=load))


def write(df: DataFrame, store: Store, table: str, mode: str, load: str | None = None) -> int:
    if mode == OVERWRITE:
        return overwrite(df, store, table)
    if mode == APPEND:
        return append(df, store, table, load)
    raise ValueError(f"write mode {mode!r} is neither {OVERWRITE!r} nor {APPEND!r}")


def declared(ddl: str) -> list[tuple[str, str]]:
    """Column names and types of a declaration such as ``id bigint, name string``."""
    return [(f.name, f.dataType.simpleString()) for f in T.StructType.fromDDL(ddl).fields]


def by_name(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """Columns in the target's order; any difference in names is refused."""
    have = {c.lower() for c in df.columns}
    want = {c.lower() for c in columns}
    if have != want or len(df.columns) != len(columns):
        raise ValueError(
            f"columns for {table} differ: missing {sorted(want - have)}, unknown {sorted(have - want)}"
        )
    return project(df, columns)


def truncate_reload(
    df: DataFrame, store: Store, table: str, ddl: str, page: int | None = None,
    database_types: str | None = None,
) -> int:
    """Create the table as declared if need be, empty it, fill it; safe to repeat."""
    fields = declared(ddl)
    named = by_name(df, [n for n, _ in fields], table)
    typed = named.select(*[F.col(n).cast(t).alias(n) for n, t in fields])
    rows = counted(typed, lambda d: store.replace(d, table, True, database_types, page))
    return confirmed(rows, df.sparkSession, store, table)


def insert_by_name(df: DataFrame, store: Store, table: str) -> int:
    """Append to an existing table, matching columns by name."""
    columns = store.columns(df.sparkSession, table)
    if columns is None:
        raise ValueError(f"table {table} does not exist")
    named = by_name(df, columns, table)
    return counted(named, lambda d: store.append(d, table))


def transfer(
    spark: SparkSession, text: str, source: Store, target: Store, table: str,
    page: int = TRANSFER_PAGE, cut: RangeSlices | None = None,
) -> int:
    """Run a query in the source and replace the rows of the target, page by page.

    A database answers in one task unless ``cut`` slices the query by a column of its result.
    """
    rows = counted(source.query(spark, text, cut), lambda d: target.replace(d, table, True, None, page))
    return confirmed(rows, spark, target, table)


def publish(
    spark: SparkSession, source: Store, staging: str, target: Store, table: str, key: str,
) -> int:
    """Staging to final table, provided it has rows and no row lacks the key.

    Snapshots are published as checked, whatever is written to the staging table meanwhile; within one
    store that is one commit, and no row is copied.
    """
    if source.identity(staging) == target.identity(table):
        raise ValueError(f"{staging} cannot be published onto itself")
    within = isinstance(source, SnapshotStore) and source == target
    checked = source.manifest(spark, staging) if within else None
    staged = source.read_manifest(spark, checked) if checked else source.read(spark, staging)
    seen = staged.agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("keyed")).first()
    if not seen["rows"] or seen["rows"] != seen["keyed"]:
        raise ValueError(
            f"{staging} is not publishable: {seen['rows']} rows, {seen['keyed']} with {key}"
        )
    if checked:
        source.adopt(spark, table, checked)
        return seen["rows"]
    return overwrite(staged, target, table)


@dataclass(frozen=True)
class CopyResult:
    source: str
    target: str
    rows: int | None
    error: str | None = None


class CopyError(RuntimeError):
    def __init__(self, results: list[CopyResult]):
        self.results = results
        failed = [f"{r.source}: {r.error}" for r in results if r.error]
        super().__init__("; ".join(failed))


def copy_tables(
    spark: SparkSession, copies: Mapping[str, tuple[str, list[str]]], source: Store, target: Store,
) -> list[CopyResult]:
    """Copy column subsets of several tables; report all failures at the end."""
    results = []
    for name, (table, columns) in copies.items():
        try:
            if source.identity(name) == target.identity(table):
                raise ValueError("source and target are the same table")
            rows = overwrite(project(source.read(spark, name), columns), target, table)
            results.append(CopyResult(name, table, rows))
        except Exception as error:  # kept for the summary, the other tables go on
            results.append(CopyResult(name, table, None, str(error).splitlines()[0]))
    if any(r.error for r in results):
        raise CopyError(results)
    return results


def preview(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in a fixed order."""
    return df.orderBy(*order).limit(rows)
