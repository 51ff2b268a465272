"""Spec-driven load: windowed scan + rename/derive + conform to target schema.

Twenty-nine of the jobs are the same shape: read one source table, keep the
rows whose time column falls in the batch window, rename and derive a few
columns, and write them to a curated table. They are declared as data
(``LoadSpec``) and run by one operator.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.window import BatchWindow, windowed
from tillroll.sources.schemas import fields
from tillroll.sources.tables import Tables

# An output column: target name -> source column name, or a Column builder
# that receives the window (for literals such as NOW()).
ColumnSource = str | Column | Callable[[BatchWindow], Column]


@dataclass(frozen=True)
class LoadSpec:
    name: str
    source: str
    target: str
    time_col: str
    columns: tuple[tuple[str, ColumnSource], ...]
    where: Callable[[], Column] | None = None
    doc: str = field(default="", compare=False)


def _resolve(src: ColumnSource, w: BatchWindow) -> Column:
    if isinstance(src, str):
        return F.col(src)
    if isinstance(src, Column):
        return src
    return src(w)


def load(spec: LoadSpec, tables: Tables, w: BatchWindow, batch_day: str | None = None) -> DataFrame:
    """The target's rows of the window; with ``batch_day``, also the calendar
    day of the source's window column, under that name."""
    df = windowed(tables[spec.source], spec.time_col, w)
    if spec.where is not None:
        df = df.where(spec.where())
    day = [] if batch_day is None else [F.to_date(spec.time_col).alias(batch_day)]
    kinds, made = dict(fields(spec.target)), dict(spec.columns)
    return df.select(*[_resolve(made[name], w).cast(kind).alias(name) for name, kind in kinds.items()], *day)


def load_job(spec: LoadSpec) -> Callable[[Tables, BatchWindow], DataFrame]:
    def job(tables: Tables, w: BatchWindow, batch_day: str | None = None) -> DataFrame:
        return load(spec, tables, w, batch_day)

    job.__name__ = spec.name
    job.__doc__ = spec.doc or f"{spec.source} -> {spec.target}, window on {spec.time_col}"
    return job
