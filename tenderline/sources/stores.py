"""Where tables live: a relational database over JDBC, or files in a shared folder.

Both offer the same few operations, so a job does not know which one it uses.
Everything read is lazy. Connection properties never show up in text.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

DEFAULT_SCHEMA = "public"
FETCH_ROWS = 10_000
BATCH_ROWS = 10_000


class Store(Protocol):
    may_repeat_rows: bool

    def identity(self, table: str) -> str: ...
    def read(self, spark: SparkSession, table: str) -> DataFrame: ...
    def query(self, spark: SparkSession, text: str) -> DataFrame: ...
    def columns(self, spark: SparkSession, table: str) -> list[str] | None: ...
    def replace(self, df: DataFrame, table: str, keep_table: bool = False, types: str | None = None, page: int | None = None) -> None: ...
    def append(self, df: DataFrame, table: str, page: int | None = None) -> None: ...
    def count(self, spark: SparkSession, table: str) -> int: ...
    def drop(self, spark: SparkSession, table: str) -> None: ...


@dataclass(frozen=True)
class RangeSlices:
    """Parallel read by equal ranges of a number or date column."""

    column: str
    lower: object
    upper: object
    slices: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.slices),
        }


@dataclass(frozen=True)
class HashSlices:
    """Parallel read by the remainder of an integer column: even where ranges are not.

    The database reads the table once for each slice, unless it has an index on the very
    expression; prefer ``range_slices`` over stored bounds for large tables.
    """

    column: str
    slices: int

    def predicates(self) -> list[str]:
        parts = [f"MOD(ABS({self.column}), {self.slices}) = {k}" for k in range(self.slices)]
        parts[0] = f"({parts[0]} OR {self.column} IS NULL)"
        return parts


@dataclass(frozen=True)
class QuantileSlices:
    """Parallel read by ranges with about equal numbers of rows, from bounds that were measured.

    A source with an index on the column reads each row once. Rows of one value stay together, and
    rows without a value are with the first slice.
    """

    column: str
    bounds: tuple[object, ...]

    def predicates(self) -> list[str]:
        at = [self._literal(b) for b in self.bounds]
        if not at:
            return ["1 = 1"]
        inner = [f"{self.column} >= {a} AND {self.column} < {b}" for a, b in zip(at[:-1], at[1:], strict=True)]
        return [f"({self.column} < {at[0]} OR {self.column} IS NULL)", *inner, f"{self.column} >= {at[-1]}"]

    @staticmethod
    def _literal(value: object) -> str:
        if isinstance(value, datetime):
            return f"TIMESTAMP '{value.isoformat(' ')}'"
        if isinstance(value, date):
            return f"DATE '{value.isoformat()}'"
        return str(value)


def quantile_slices(rows: DataFrame, column: str, slices: int) -> QuantileSlices:
    """Slices over the values of a number, date or time column, measured in one pass over that column.

    Quantiles are formed in the map tasks from sketches of a fixed size; ``slices`` numbers reach the driver.
    The error of a bound is a hundredth of a slice.
    """
    shares = [k / slices for k in range(1, slices)]
    if not shares:
        return QuantileSlices(column, ())
    found = rows.agg(F.percentile_approx(column, shares, 100 * slices).alias("at")).first()["at"]
    return QuantileSlices(column, tuple(sorted(set(found or ()))))


def sliced(rows: DataFrame, cut: QuantileSlices) -> list[DataFrame]:
    """The slices of a table as frames, each with its condition on the source."""
    return [rows.where(p) for p in cut.predicates()]


@dataclass(frozen=True)
class JdbcStore:
    url: str
    properties: dict[str, str] = field(default_factory=dict, repr=False, compare=False)
    slices: dict[str, RangeSlices | HashSlices | QuantileSlices] = field(default_factory=dict, compare=False)
    writers: int | None = None

    # A task that committed its rows and is then lost runs again and repeats them.
    may_repeat_rows = True

    def cut(self, table: str) -> RangeSlices | HashSlices | QuantileSlices | None:
        """The slices of a table, whichever way its name is written."""
        wanted = self.qualified(table).lower()
        return next((c for n, c in self.slices.items() if self.qualified(n).lower() == wanted), None)

    def qualified(self, table: str) -> str:
        return table if "." in table else f"{DEFAULT_SCHEMA}.{table}"

    def identity(self, table: str) -> str:
        return f"{self.url.split('?')[0].rstrip('/')} {self.qualified(table)}".lower()

    def read_options(self, table: str) -> dict[str, str]:
        options = {
            **self.properties,
            "url": self.url,
            "dbtable": self.qualified(table),
            "fetchsize": str(FETCH_ROWS),
            "preferTimestampNTZ": "true",
        }
        cut = self.cut(table)
        return {**options, **cut.options()} if isinstance(cut, RangeSlices) else options

    def query_options(self, text: str, cut: RangeSlices | None = None) -> dict[str, str]:
        text = text.strip().rstrip(";")
        options = {
            **self.properties,
            "url": self.url,
            "fetchsize": str(FETCH_ROWS),
            "preferTimestampNTZ": "true",
        }
        # Spark slices tables only, so a sliced query is read as one.
        return {**options, "dbtable": f"({text}) q", **cut.options()} if cut else {**options, "query": text}

    def write_options(
        self, table: str, keep_table: bool = False, types: str | None = None, page: int | None = None
    ) -> dict[str, str]:
        options = {
            **self.properties,
            "url": self.url,
            "dbtable": self.qualified(table),
            "batchsize": str(page or BATCH_ROWS),
        }
        if self.writers:
            options["numPartitions"] = str(self.writers)
        if keep_table:
            options["truncate"] = "true"
        if types:
            options["createTableColumnTypes"] = types
        return options

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        cut = self.cut(table)
        if isinstance(cut, (HashSlices, QuantileSlices)):
            more = {**self.properties, "fetchsize": str(FETCH_ROWS), "preferTimestampNTZ": "true"}
            return spark.read.jdbc(
                self.url, self.qualified(table), predicates=cut.predicates(), properties=more
            )
        return spark.read.format("jdbc").options(**self.read_options(table)).load()

    def query(self, spark: SparkSession, text: str, cut: RangeSlices | None = None) -> DataFrame:
        """The rows of a query; one task without ``cut``."""
        return spark.read.format("jdbc").options(**self.query_options(text, cut)).load()

    def count(self, spark: SparkSession, table: str) -> int:
        """Counted by the database: one row comes back."""
        return int(self.query(spark, f"SELECT COUNT(*) AS n FROM {self.qualified(table)}").first()[0])

    def drop(self, spark: SparkSession, table: str) -> None:
        """Tables of a database are left to its owner."""

    def range_slices(self, spark: SparkSession, table: str, column: str, slices: int) -> RangeSlices | None:
        """Ranges over the values present; the database answers with one row."""
        row = self.query(
            spark,
            f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {self.qualified(table)}",
        ).first()
        return None if row[0] is None else RangeSlices(column, row[0], row[1], slices)

    def quantile_slices(self, spark: SparkSession, table: str, column: str, slices: int) -> QuantileSlices:
        """Even slices, from one read of the column alone."""
        return quantile_slices(self.query(spark, f"SELECT {column} FROM {self.qualified(table)}"), column, slices)

    def columns(self, spark: SparkSession, table: str) -> list[str] | None:
        try:
            return self.read(spark, table).columns
        except Exception as error:  # the driver reports a missing table in its own words
            if any(m in str(error).lower() for m in ("does not exist", "not found", "doesn't exist")):
                return None
            raise

    def _writer(self, df: DataFrame, options: dict[str, str]) -> DataFrameWriter:
        return df.write.format("jdbc").options(**options)

    def replace(
        self, df: DataFrame, table: str, keep_table: bool = False,
        types: str | None = None, page: int | None = None,
    ) -> None:
        options = self.write_options(table, keep_table, types, page)
        self._writer(df, options).mode("overwrite").save()

    def append(self, df: DataFrame, table: str, page: int | None = None) -> None:
        self._writer(df, self.write_options(table, page=page)).mode("append").save()


@dataclass(frozen=True)
class FileStore:
    """Parquet tables under one folder that every executor can reach."""

    root: str
    suffix: str = ""

    may_repeat_rows = False

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}{self.suffix}"

    def identity(self, table: str) -> str:
        return self.path(table)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(self.path(table))

    def query(self, spark: SparkSession, text: str, cut: RangeSlices | None = None) -> DataFrame:
        """A query over ``{table}`` names in braces, resolved to tables of this store."""
        names = sorted({part.split("}")[0] for part in text.split("{")[1:]})
        return spark.sql(text.strip().rstrip(";"), **{n: self.read(spark, n) for n in names})

    def columns(self, spark: SparkSession, table: str) -> list[str] | None:
        try:
            return self.read(spark, table).columns
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def replace(
        self, df: DataFrame, table: str, keep_table: bool = False,
        types: str | None = None, page: int | None = None,
    ) -> None:
        """Written beside the table and put in its place when whole: a failed write leaves the old one."""
        path = self.path(table)
        new, old = (f"{path}.{word}-{uuid.uuid4().hex}" for word in ("new", "old"))
        df.write.parquet(new)
        files, hadoop = self._files(df.sparkSession)
        if files.exists(hadoop.Path(path)) and not files.rename(hadoop.Path(path), hadoop.Path(old)):
            raise OSError(f"{path} cannot be moved aside; the new rows are in {new}")
        if not files.rename(hadoop.Path(new), hadoop.Path(path)):
            files.rename(hadoop.Path(old), hadoop.Path(path))
            raise OSError(f"{path} cannot be replaced; the new rows are in {new}")
        files.delete(hadoop.Path(old), True)
        df.sparkSession.catalog.refreshByPath(path)

    def _files(self, spark: SparkSession):
        """The file system that the folder is in, as the session reaches it."""
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        return hadoop.Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop

    def count(self, spark: SparkSession, table: str) -> int:
        return self.read(spark, table).agg(F.count(F.lit(1))).first()[0]

    def drop(self, spark: SparkSession, table: str) -> None:
        files, hadoop = self._files(spark)
        files.delete(hadoop.Path(self.path(table)), True)

    def append(self, df: DataFrame, table: str, page: int | None = None) -> None:
        df.write.mode("append").parquet(self.path(table))


def count_rows(store: Store, spark: SparkSession, table: str) -> int:
    return store.count(spark, table)


def check_columns(df: DataFrame, needed: Sequence[str], table: str) -> DataFrame:
    """Fail before any work if a column that a job reads is not there."""
    present = {c.lower() for c in df.columns}
    missing = [c for c in needed if c.lower() not in present]
    if missing:
        raise ValueError(f"table {table} lacks the columns {missing}")
    return df


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster shares, for staging tables.

    The session's ``spark.checkpoint.dir`` decides; without it only a local session
    gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder all executors share")
        import tempfile

        root = tempfile.mkdtemp(prefix="tenderline-")
    return f"{root.rstrip('/')}/tenderline-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """The rows, computed once and read back from a staging table.

    For what would come out differently if it were computed again, such as the numbers of
    partitions. The table stays until the owner of the folder clears it: it is read lazily.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
