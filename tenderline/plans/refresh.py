"""Bringing the pricebook table up to date from what differs between two loads of its inputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderline import catalog as names
from tenderline.operators.changes import bucket_of, change_set, key_digests
from tenderline.operators.demand import demand_partials, merged_partials, yearly_from
from tenderline.operators.pivot import attribute_pivot
from tenderline.plans.jobs import JOBS
from tenderline.plans.runner import read_sources
from tenderline.sources.snapshots import SnapshotStore
from tenderline.sources.stores import Store, staged

BUCKETS = 64
# Tasks that write one bucket, so that none has to take all rows of one: so many at least, and one for each so many of its products.
WRITERS_PER_BUCKET = 4
PRODUCTS_PER_WRITER = 250_000

PRODUCTS, VALUES, FIELDS, HEADERS = (s.name for s in JOBS["pricebook_info"].sources)
#: Per input the key that its digests go by, and the columns that the table depends on.
WATCHED = {
    PRODUCTS: ("product_id", names.PRICEBOOK_PRODUCT),
    VALUES: ("pb_product_id", ["pb_required_field_id", "field_value"]),
    FIELDS: ("id", ["field_name"]),
    HEADERS: ("id", list(names.PRICEBOOK_HEADER)),
}


@dataclass(frozen=True)
class Refresh:
    full: bool
    products: int
    buckets: tuple[int, ...]


def _digest_table(source: str) -> str:
    return f"{JOBS['pricebook_info'].target}_digests_{source}"


def _touched(frames: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """The products whose rows may differ: they, their values, their header or the name of a field changed."""

    def of(frame: DataFrame, key: str, source: str, product: str) -> DataFrame:
        keys = changed[source].select(F.col("key").alias(key))
        return frame.join(keys, key, "left_semi").select(F.col(product).alias("product_id"))

    found = changed[PRODUCTS].select(F.col("key").alias("product_id"))
    found = found.unionByName(changed[VALUES].select(F.col("key").alias("product_id")))
    found = found.unionByName(of(frames[VALUES], "pb_required_field_id", FIELDS, "pb_product_id"))
    found = found.unionByName(of(frames[PRODUCTS], "pricebook_id", HEADERS, "product_id"))
    return found.where("product_id IS NOT NULL").distinct()


def _with_bucket(rows: DataFrame, buckets: int, products: int) -> DataFrame:
    """Rows placed by bucket, each bucket in a few tasks, or more where the ``products`` of all buckets are many."""
    writers = max(WRITERS_PER_BUCKET, -(-products // (buckets * PRODUCTS_PER_WRITER)))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(writers))
    many = max(buckets * writers, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.withColumn("bucket", bucket_of("product_id", buckets)).repartition(many, "bucket", salt)


def refresh_by_changes(
    spark: SparkSession, source: Store, target: SnapshotStore, buckets: int = BUCKETS,
    attributes: dict[str, str] | None = None,
) -> Refresh:
    """Make the pricebook table what a full load would make it, by computing what changed.

    The digests of all four inputs are kept beside the table, per product, field and header. A
    refresh reads the inputs once for their digests and compares them with those of the last load, so that
    insertions, changes and removals are seen wherever they happen, also in headers and field
    names and without any column of change times. Products that may differ are computed anew, their buckets are
    written and committed at once; the files of all other buckets stay as they are. The digests, taken before the rows
    were read, are committed last: a run that is lost in between, or inputs that change
    meanwhile, lead to the same products being computed again.

    ``buckets`` has to be the same in all refreshes of a table.
    """
    job = JOBS["pricebook_info"]
    frames = read_sources(spark, job.sources, source)
    attributes = attributes or names.ATTRIBUTES
    now = {s: staged(key_digests(frames[s], key, list(columns))) for s, (key, columns) in WATCHED.items()}
    listed = now[PRODUCTS].agg(F.sum("rows")).first()[0] or 0
    full = target.manifest(spark, job.target) is None or any(target.manifest(spark, _digest_table(s)) is None for s in WATCHED)
    if full:
        target.replace_buckets(_with_bucket(attribute_pivot(*(frames[s] for s in WATCHED), attributes), buckets, listed), job.target)
        report = Refresh(True, 0, ())
    else:
        changed = {s: staged(change_set(target.read(spark, _digest_table(s)), now[s])) for s in WATCHED}
        products = staged(_touched(frames, changed))
        hit = sorted(r["bucket"] for r in products.select(bucket_of("product_id", buckets).alias("bucket")).distinct().collect())
        report = Refresh(False, products.count(), tuple(hit))
        if hit:
            some = {
                PRODUCTS: frames[PRODUCTS].join(products, "product_id", "left_semi").select(*frames[PRODUCTS].columns),
                VALUES: frames[VALUES].join(products, frames[VALUES]["pb_product_id"] == products["product_id"], "left_semi"),
            }
            fresh = attribute_pivot(*({**frames, **some}[s] for s in WATCHED), attributes)
            kept = target.read_buckets(spark, job.target, hit).join(products, "product_id", "left_anti")
            rows = kept.select(*fresh.columns).unionByName(fresh)
            target.replace_buckets(_with_bucket(rows, buckets, listed), job.target, hit)
    for s, digests in now.items():
        target.replace(digests, _digest_table(s))
    return report


DEMAND_STATE = "demand_partials"


def add_demand(changes: DataFrame, store: SnapshotStore, load: str, sign: str | None = "change") -> None:
    """Add rows of materials to the yearly demand, or take them away where ``sign`` is negative.

    What is stored are the partials of each load, a few per material that occurs in it; earlier rows are not read.
    A load that is repeated replaces itself.
    """
    store.append(demand_partials(changes, sign), DEMAND_STATE, load=load)


def yearly_demand_of(spark: SparkSession, store: SnapshotStore, corrected: bool = False) -> DataFrame:
    """Yearly demand of all rows added and not taken away, from the partials alone."""
    return yearly_from(merged_partials(store.read(spark, DEMAND_STATE)), corrected)


def compact_demand(spark: SparkSession, store: SnapshotStore) -> None:
    """The partials of all loads as one; the ledger of loads is forgotten, so none of them may be repeated."""
    store.replace(merged_partials(store.read(spark, DEMAND_STATE)), DEMAND_STATE)
