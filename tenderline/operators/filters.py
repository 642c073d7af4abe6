"""Row filters and column selections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tenderline.catalog import SALES_THRESHOLD
from tenderline.functions.scalar import AsOf, day_before, moment


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c) for c in columns])


def above_threshold(sales: DataFrame, threshold: float = SALES_THRESHOLD) -> DataFrame:
    return sales.where(F.col("amount") > threshold)


def known_by(df: DataFrame, column: str, as_of: AsOf) -> DataFrame:
    """Rows dated at or before the given time."""
    return df.where(F.col(column) <= moment(as_of, df.schema[column].dataType.simpleString()))


def high_water_mark(target: DataFrame, column: str, as_of: AsOf) -> AsOf:
    """Greatest loaded time, or the day before ``as_of`` for an empty target."""
    found = target.agg(F.max(column).cast("string").alias("mark")).first()["mark"]
    return found or day_before(as_of)


def changed_since(df: DataFrame, column: str, mark: AsOf) -> DataFrame:
    """Rows newer than the mark; a literal comparison that sources can evaluate."""
    return df.where(F.col(column) > moment(mark, df.schema[column].dataType.simpleString()))
