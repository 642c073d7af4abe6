"""Landed responses taken in once: a ledger of files, and batches that can be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tenderline.catalog import RATE_PAYLOAD_SCHEMA, TARGET_CURRENCIES
from tenderline.sources.rates import accepted, malformed, of_currencies, rejected, to_rates
from tenderline.sources.snapshots import SnapshotStore

RATES, FAILED, MALFORMED = "currency_rates", "currency_rates_failed", "currency_rates_malformed"


def ingest_rates(
    spark: SparkSession, landed: str, store: SnapshotStore, whole_files: bool = False,
    currencies: Sequence[str] | None = TARGET_CURRENCIES, files_per_batch: int | None = None,
) -> list[str]:
    """Take in the responses that landed since the last call; the names of the loads made.

    Spark's file source keeps the list of files it has seen in a checkpoint below the store, so a call
    reads new files only and ends when there are none left. Each batch is appended
    under its number: a call that is lost between a batch and its checkpoint sees that batch again, with
    the same number and files, and its rows replace those of the first try. Failed responses and texts that are
    no JSON go to tables of their own, so they neither stop the others nor get lost. A file has to
    be whole when it lands (written elsewhere and moved), and is not read again when it changes.
    """
    reader = spark.readStream.schema(f"{RATE_PAYLOAD_SCHEMA}, malformed string")
    reader = reader.option("columnNameOfCorruptRecord", "malformed").option("multiLine", whole_files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    loads: list[str] = []

    def take(batch: DataFrame, number: int) -> None:
        load = f"batch-{number}"
        rates = to_rates(accepted(batch))
        store.append(of_currencies(rates, currencies) if currencies else rates, RATES, load=load)
        store.append(rejected(batch.where("malformed IS NULL")), FAILED, load=load)
        store.append(malformed(batch), MALFORMED, load=load)
        loads.append(load)

    state = f"{store.root.rstrip('/')}/_seen/{RATES}"
    writer = reader.json(landed).writeStream.foreachBatch(take).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return loads
