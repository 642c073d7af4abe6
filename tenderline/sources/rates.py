"""Currency rates and symbols from landed service responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderline.catalog import (
    RATE_PAYLOAD_SCHEMA,
    RATE_SCHEMA,
    SYMBOLS_PAYLOAD_SCHEMA,
    TARGET_CURRENCIES,
)


def rates_from_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """A few rates at hand, as a frame with the declared columns."""
    names = [part.split()[0] for part in RATE_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RATE_SCHEMA)


def read_payloads(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed responses: one per line, or one per file with ``whole_files``.

    A response that is not JSON has its text in ``malformed`` and nothing else.
    """
    schema = f"{RATE_PAYLOAD_SCHEMA}, malformed string"
    return spark.read.schema(schema).json(path, multiLine=whole_files, columnNameOfCorruptRecord="malformed")


def _succeeded():
    return F.coalesce(F.col("success"), F.lit(False))


def accepted(payloads: DataFrame) -> DataFrame:
    return payloads.where(_succeeded())


def rejected(payloads: DataFrame) -> DataFrame:
    """Failed responses with their message, to be stored apart."""
    return payloads.where(~_succeeded()).select(
        F.coalesce("message", F.lit("Unknown error")).alias("message"), "base", "date"
    )


def malformed(payloads: DataFrame) -> DataFrame:
    """The texts that are not JSON, to be stored apart."""
    # Spark does not read the text of a bad record without another column.
    return payloads.where(F.col("success").isNull() & F.col("malformed").isNotNull()).select("malformed")


def all_accepted(payloads: DataFrame) -> DataFrame:
    """The strict form: a failed response fails the job when it runs."""
    message = F.coalesce("message", F.lit("Unknown error"))
    return payloads.where(
        F.when(_succeeded(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    )


def to_rates(payloads: DataFrame) -> DataFrame:
    """One row per currency of each response; the date stays text."""
    return payloads.select(
        F.explode("rates").alias("target_currency", "rate"), "base", "date"
    )


def of_currencies(rates: DataFrame, currencies: Sequence[str] = TARGET_CURRENCIES) -> DataFrame:
    return rates.where(F.col("target_currency").isin(list(currencies)))


def read_symbols(spark: SparkSession, path: str, whole_files: bool = True, strict: bool = False) -> DataFrame:
    """Currency codes and names, each pair once; with ``strict`` a failed or malformed response raises."""
    payloads = spark.read.schema(SYMBOLS_PAYLOAD_SCHEMA).json(path, multiLine=whole_files)
    if strict:
        failed = F.raise_error(F.lit("a symbols response failed")).cast("boolean")
        payloads = payloads.where(F.when(_succeeded(), F.lit(True)).otherwise(failed))
    return accepted(payloads).select(F.explode("symbols").alias("code", "name")).distinct()
