"""Descriptions of jobs: what is read, what is computed, where it goes."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame

from tenderline.sinks.tables import APPEND, OVERWRITE

Transform = Callable[[dict[str, DataFrame], dict[str, Any]], DataFrame]


@dataclass(frozen=True)
class TableSource:
    """A table, the columns a job reads from it, and the names SQL may use for it.

    ``columns`` are all that is read; a job that passes others on names only those it
    cannot do without, as ``needed``.
    """

    name: str
    alias: str = ""
    view_name: str = ""
    columns: tuple[str, ...] = ()
    needed: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return self.alias or self.name.split(".")[-1]

    @property
    def views(self) -> tuple[str, ...]:
        """The view name and the alias, so texts written for either one work."""
        return tuple(dict.fromkeys(v for v in (self.view_name, self.key) if v))


@dataclass(frozen=True)
class JobSpec:
    name: str
    sources: tuple[TableSource, ...]
    target: str | None
    transform: Transform | str | None = None
    mode: str = OVERWRITE
    defaults: Mapping[str, Any] = field(default_factory=dict)
    #: Source and column that an incremental run filters by: rows later than its ``since``.
    changed_by: tuple[str, str] | None = None

    def __post_init__(self):
        if self.mode not in (OVERWRITE, APPEND):
            raise ValueError(f"{self.name}: unknown write mode {self.mode!r}")
        names = [v for s in self.sources for v in s.views]
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"{self.name}: source names used twice: {twice}")


def selection(columns: list[str]) -> Transform:
    """The transform of a plain column list over a single source."""

    def pick(frames: dict[str, DataFrame], _: dict[str, Any]) -> DataFrame:
        (only,) = frames.values()
        return only.select(*columns)

    return pick


def projection_job(name: str, source: str | None, target: str | None, columns: list[str],
                   mode: str = OVERWRITE) -> JobSpec:
    sources = (TableSource(source, columns=tuple(columns)),) if source else ()
    return JobSpec(name, sources, target, selection(columns), mode)


def _no_repeats(pairs: list[tuple[str, Any]]) -> dict[str, Any]:
    found: dict[str, Any] = {}
    for key, value in pairs:
        if key in found:
            raise ValueError(f"key {key!r} is given twice")
        found[key] = value
    return found


def parse_config(text: str) -> dict[str, Any]:
    """Configuration text, JSON or YAML; a repeated key is an error in both."""
    if text.lstrip().startswith("{"):
        return json.loads(text, object_pairs_hook=_no_repeats)
    try:
        import yaml
    except ImportError as error:
        raise ValueError("reading YAML needs the yaml package; JSON works without") from error

    class Loader(yaml.SafeLoader):
        pass

    Loader.add_constructor(
        yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG,
        lambda loader, node: _no_repeats(
            [(loader.construct_object(k, deep=True), loader.construct_object(v, deep=True))
             for k, v in node.value]
        ),
    )
    return yaml.load(text, Loader)


KNOWN_KEYS = frozenset(
    "source_table source_tables target_table write_mode columns join_tables filter_column".split()
)


def _filter_column(name: str, entry: Mapping[str, Any], sources: tuple[TableSource, ...]) -> tuple[str, str] | None:
    """``table.column`` or ``schema.table.column`` of a declared source; a bare column where there is one source."""
    text = entry.get("filter_column")
    if not text:
        return None
    table, _, column = text.rpartition(".")
    named = [s.key for s in sources if table in (s.name, s.name.split(".")[-1], *s.views)] if table else [s.key for s in sources]
    if len(named) != 1:
        raise ValueError(f"{name}: filter_column {text!r} does not name a column of one source")
    return named[0], column


def _check_joins(name: str, entry: Mapping[str, Any], sources: tuple[TableSource, ...]) -> None:
    known = {n for s in sources for n in (s.name, s.name.split(".")[-1], *s.views)}
    strange = sorted(set(entry.get("join_tables") or ()) - known)
    if strange:
        raise ValueError(f"{name}: join_tables {strange} are not among the sources")


def jobs_from_config(text: str) -> dict[str, JobSpec]:
    """Jobs declared in a configuration file, each checked once.

    An entry has ``source_table`` with ``columns``, or ``source_tables`` for a SQL
    text given at run time; ``target_table`` and ``write_mode`` may be left to the caller.
    ``join_tables`` has to name declared sources. ``filter_column`` names a column of one of them: a run that
    is given ``since`` reads only later rows of that source. Any other key is an error.
    """
    jobs = {}
    for name, entry in (parse_config(text) or {}).items():
        strange = sorted(set(entry) - KNOWN_KEYS)
        if strange:
            raise ValueError(f"{name}: unknown keys {strange}")
        mode = entry.get("write_mode") or OVERWRITE
        if "columns" in entry:
            job = projection_job(
                name, entry.get("source_table"), entry.get("target_table"), entry["columns"], mode
            )
        elif "source_tables" in entry:
            sources = tuple(
                TableSource(
                    f"{s['schema']}.{s['name']}" if s.get("schema") else s["name"],
                    s.get("alias") or s["name"],
                    s.get("view_name", ""),
                )
                for s in entry["source_tables"]
            )
            job = JobSpec(name, sources, entry.get("target_table"), None, mode)
        else:
            raise ValueError(f"{name}: neither columns nor source_tables")
        _check_joins(name, entry, job.sources)
        jobs[name] = replace(job, changed_by=_filter_column(name, entry, job.sources))
    return jobs
