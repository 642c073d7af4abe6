"""Transfers in pages of keys that go on where they stopped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F

from tenderline.sources.snapshots import SnapshotStore
from tenderline.sources.stores import QuantileSlices, Store, quantile_slices

PAGE_ROWS = 5_000_000


@dataclass(frozen=True)
class Transfer:
    pages: int
    done_before: int
    rows: int


def _plan(spark: SparkSession, source: Store, text: str, key: str, store: SnapshotStore, name: str, page_rows: int) -> list[str]:
    """The conditions of the pages. They are measured at the first try and kept: a later one has to find the same pages."""
    if store.manifest(spark, name) is None:
        keys = source.query(spark, text).select(key)
        pages = max(1, -(-keys.count() // page_rows))
        cut: QuantileSlices = quantile_slices(keys, key, pages)
        rows = list(enumerate(cut.predicates()))
        store.replace(spark.createDataFrame(rows, "page int, condition string").coalesce(1), name)
    return [r["condition"] for r in store.read(spark, name).orderBy("page").collect()]


def transfer_in_pages(
    spark: SparkSession, text: str, source: Store, target: SnapshotStore, table: str, key: str, page_rows: int = PAGE_ROWS,
) -> Transfer:
    """Run a query in the source page by page and replace the target by its rows, all at once at the end.

    Pages are ranges of ``key`` with about ``page_rows`` rows, evenly measured; each is a job of
    its own and is committed as a load of an incoming table. That ledger is the progress: a transfer that was lost goes on
    with the first page that is not in it, and a page that was written but not committed is written again, once.
    Readers see the old table until the last page is there. One manifest then makes the incoming rows the
    table, without copying them. The source must not change between the tries; ``restart`` forgets them.
    """
    incoming, plan = f"{table}__incoming", f"{table}__pages"
    conditions = _plan(spark, source, text, key, target, plan, page_rows)
    seen = target.manifest(spark, incoming)
    done = set(seen.loads) if seen else set()
    rows = source.query(spark, text)
    for number, condition in enumerate(conditions):
        load = f"page-{number}"
        if load not in done:
            target.append(rows.where(condition), incoming, load=load)
    made = target.manifest(spark, incoming)
    count = target.read_manifest(spark, made).agg(F.count(F.lit(1))).first()[0]
    target.adopt(spark, table, made)
    restart(spark, target, table)
    return Transfer(len(conditions), len(done), count)


def restart(spark: SparkSession, target: SnapshotStore, table: str) -> None:
    """Forget the pages of a transfer: the next one starts anew. The table stays."""
    target.drop(spark, f"{table}__incoming")
    target.drop(spark, f"{table}__pages")
