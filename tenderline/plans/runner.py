"""Running a job: check, read lazily, transform, write once."""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tenderline.functions.scalar import AsOf
from tenderline.operators.filters import changed_since
from tenderline.plans.spec import JobSpec, TableSource
from tenderline.sinks.tables import overwrite, publish, write
from tenderline.sources.stores import Store, check_columns, shared_folder  # noqa: F401 (callers take it from here)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunReport:
    job: str
    target: str
    mode: str
    rows: int


def read_sources(
    spark: SparkSession, sources: tuple[TableSource, ...], store: Store
) -> dict[str, DataFrame]:
    """Alias to frame for every source; nothing is executed."""
    return {
        s.key: check_columns(store.read(spark, s.name), (*s.columns, *s.needed), s.name)
        for s in sources
    }


def land_sources(
    spark: SparkSession, sources: tuple[TableSource, ...], store: Store, landing: Store
) -> None:
    """Copy what a job reads of each source, so that the source is read only once.

    ``columns`` of a source are all that its job reads; without them all are copied.
    """
    for s in sources:
        frame = check_columns(store.read(spark, s.name), (*s.columns, *s.needed), s.name)
        overwrite(frame.select(*s.columns) if s.columns else frame, landing, s.name)


def sql_file(path: str) -> str:
    file = Path(path)
    if not file.is_file():
        raise FileNotFoundError(f"no SQL text at {path}")
    return file.read_text(encoding="utf-8")


def run_sql(
    spark: SparkSession, text: str, frames: dict[str, DataFrame], args: dict[str, Any] | None = None
) -> DataFrame:
    """One SQL statement over named frames, with ``:name`` parameters.

    Views exist only while the text is resolved; the frame keeps its own plan. A view
    the caller has under one of the names is not replaced: that is an error.
    """
    made = []
    try:
        for name, frame in frames.items():
            frame.createTempView(name)
            made.append(name)
        return spark.sql(text.strip().rstrip(";"), args=args or {})
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def incremental(job: JobSpec, frames: dict[str, DataFrame], since: AsOf) -> dict[str, DataFrame]:
    """The inputs with only the later rows of the source that the job filters by."""
    if job.changed_by is None:
        raise ValueError(f"{job.name} names no column that changes are told by")
    source, column = job.changed_by
    frame = check_columns(frames[source], (column,), source)
    return {**frames, source: changed_since(frame, column, since)}


def transform(
    spark: SparkSession, job: JobSpec, frames: dict[str, DataFrame], args: dict[str, Any]
) -> DataFrame:
    if isinstance(job.transform, str):
        named = {v: frames[s.key] for s in job.sources for v in s.views}
        return run_sql(spark, job.transform, named, args)
    if job.transform is None:
        raise ValueError(f"{job.name}: a SQL text has to be given")
    return job.transform(frames, {**job.defaults, **args})


def prepare(
    job: JobSpec, source_table: str | None, target_table: str | None,
    mode: str | None, sql: str | None,
) -> JobSpec:
    """The job with what the caller overrides; raises if anything is still open."""
    changes: dict[str, Any] = {}
    if source_table:
        if len(job.sources) > 1:
            raise ValueError(f"{job.name}: only a job with one source can be pointed elsewhere")
        first = job.sources[0] if job.sources else TableSource(source_table)
        changes["sources"] = (replace(first, name=source_table, alias=first.key),)
    if target_table:
        changes["target"] = target_table
    if mode:
        changes["mode"] = mode
    if sql:
        changes["transform"] = sql
    ready = replace(job, **changes)
    if not ready.sources or not ready.target:
        raise ValueError(f"{job.name}: source and target tables have to be given")
    return ready


def run(
    spark: SparkSession,
    job: JobSpec,
    source: Store,
    target: Store,
    args: dict[str, Any] | None = None,
    source_table: str | None = None,
    target_table: str | None = None,
    mode: str | None = None,
    sql: str | None = None,
    landing: Store | None = None,
    load: str | None = None,
    since: AsOf | None = None,
) -> RunReport:
    """Run a job with one execution of its plan for the write.

    Some transforms look at their inputs while the plan is built: jobs with joins and
    windows count rows, and look for crowded keys in inputs above the row floor.

    Refuses to write onto one of its own sources: a lazy read would find it emptied.
    With ``landing`` the sources are copied there first, and the job reads the copies.
    ``load`` names this run of a job that appends, into a store of snapshots: the run can then
    be repeated, and its rows are there once. With ``since`` only later rows are read of the
    source that the job's configuration names.
    """
    ready = prepare(job, source_table, target_table, mode, sql)
    goal = target.identity(ready.target)
    for s in ready.sources:
        if source.identity(s.name) == goal:
            raise ValueError(f"{ready.name}: {ready.target} is also a source; use a staging table")
        if landing is not None and landing.identity(s.name) in {
            goal, *(source.identity(other.name) for other in ready.sources)
        }:
            raise ValueError(f"{ready.name}: landing {s.name} would replace a source or the target")
    if landing is not None:
        land_sources(spark, ready.sources, source, landing)
        source = landing
    frames = read_sources(spark, ready.sources, source)
    if since is not None:
        frames = incremental(ready, frames, since)
    rows = write(transform(spark, ready, frames, dict(args or {})), target, ready.target, ready.mode, load)
    log.info("%s wrote %d rows to %s (%s)", ready.name, rows, ready.target, ready.mode)
    return RunReport(ready.name, ready.target, ready.mode, rows)


def run_staged(
    spark: SparkSession,
    job: JobSpec,
    source: Store,
    staging: Store,
    target: Store,
    table: str,
    key: str,
    args: dict[str, Any] | None = None,
) -> RunReport:
    """Run a job into its staging table, check that, and publish it as ``table``."""
    staged = run(spark, job, source, staging, args)
    rows = publish(spark, staging, staged.target, target, table, key)
    staging.drop(spark, staged.target)
    return RunReport(job.name, table, staged.mode, rows)
