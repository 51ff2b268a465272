"""Writing job results.

INSERT jobs replace the days (or the window) they state and nothing else:

* ``write_days``: tables partitioned by a calendar day, either that of one of
  their own time columns (``<column>__day``, see ``schemas.PARTITION_TIME``)
  or that of the source's window column, kept as ``batch_day``. Days with rows
  are replaced by dynamic partition overwrite; a stated day that has no rows
  any more is emptied after the new rows are in place. A row of any other day
  fails the write before it commits.
* ``write_window``: tables without a day (monthly or per-user marts) are
  partitioned by the window itself; a window that overlaps another one than
  itself is refused.
* ``replace_keys``: single keys' rows on some days, in the partitions that
  hold them (ledger days behind a rewritten one, a product's price history).

UPDATE jobs return the partitions that hold a changed row, and
``rewrite_partitions`` replaces those. An update that must not be applied
twice writes what it takes, by window, to a table of its own, and readers
subtract what is due (``inventory.stock_on_hand``).

A ``Store`` says where tables live: ``ParquetStore`` (folders below a root) or
``CatalogStore`` (the session catalog).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillroll.functions.window import DAY_SUFFIX, BatchWindow, day_partition
from tillroll.operators.sizing import join_small
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.schemas import BATCH_DAY, BATCH_WINDOW, PARTITION_BY_HASH, with_bucket


class Store:
    """Where tables live. ``replace`` overwrites exactly the partitions that
    ``df`` has rows in; ``empty`` leaves one partition without rows."""

    spark: SparkSession

    def read(self, table: str) -> DataFrame | None:
        raise NotImplementedError

    def replace(self, table: str, df: DataFrame, parts: Sequence[str]) -> None:
        raise NotImplementedError

    def replace_all(self, table: str, df: DataFrame) -> None:
        raise NotImplementedError

    def empty(self, table: str, df: DataFrame, partition: dict[str, str]) -> None:
        raise NotImplementedError


class ParquetStore(Store):
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self._readable(table))
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def replace(self, table: str, df: DataFrame, parts: Sequence[str]) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(self.path(table))

    def empty(self, table: str, df: DataFrame, partition: dict[str, str]) -> None:
        folder = "/".join(f"{k}={v}" for k, v in partition.items())
        self.spark.createDataFrame([], df.drop(*partition).schema).write.mode("overwrite").parquet(f"{self.path(table)}/{folder}")

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def replace_all(self, table: str, df: DataFrame) -> None:
        """An unpartitioned table: the new one is written beside the old and
        takes its name once it is whole."""
        fs, path = self._files()
        self._recover(table)
        own, new, old = (path(self.path(table) + x) for x in ("", ".next", ".previous"))
        df.write.mode("overwrite").parquet(new.toString())
        fs.delete(old, True)
        if fs.exists(own) and not fs.rename(own, old):
            raise OSError(f"cannot move {own.toString()}")
        if not fs.rename(new, own):
            raise OSError(f"cannot move {new.toString()}")
        fs.delete(old, True)

    def _readable(self, table: str) -> str:
        """Where the table is: between the two moves of a writer, or after a
        crash there, the new one if it is whole, else the old one. Readers
        move nothing."""
        fs, path = self._files()
        own, new, old = (self.path(table) + x for x in ("", ".next", ".previous"))
        if fs.exists(path(own)) or not fs.exists(path(old)):
            return own
        return new if fs.exists(path(new, "_SUCCESS")) else old

    def _recover(self, table: str) -> None:
        """A writer first gives a table its name back that a crash between
        the two moves took."""
        fs, path = self._files()
        found = self._readable(table)
        if found != self.path(table):
            fs.rename(path(found), path(self.path(table)))


class CatalogStore(Store):
    """Tables of the session catalog, created on their first write."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def read(self, table: str) -> DataFrame | None:
        return self.spark.table(table) if self.spark.catalog.tableExists(table) else None

    def _create(self, table: str, df: DataFrame, parts: Sequence[str]) -> None:
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
            self.spark.createDataFrame([], df.schema).write.partitionBy(*parts).format("parquet").saveAsTable(table)

    def replace(self, table: str, df: DataFrame, parts: Sequence[str]) -> None:
        self._create(table, df, parts)
        columns = self.spark.table(table).columns
        df.select(*columns).write.option("partitionOverwriteMode", "dynamic").insertInto(table, overwrite=True)

    def replace_all(self, table: str, df: DataFrame) -> None:
        """The catalog commits an unpartitioned overwrite; the rows were
        checkpointed before, so a failed one can be repeated from there."""
        self._create(table, df, [])
        df.select(*self.spark.table(table).columns).write.insertInto(table, overwrite=True)

    def empty(self, table: str, df: DataFrame, partition: dict[str, str]) -> None:
        spec = ", ".join(f"{k} = '{v}'" for k, v in partition.items())
        kinds = [(c, k) for c, k in self.spark.table(table).dtypes if c not in partition]
        nothing = ", ".join(f"CAST(NULL AS {k}) AS `{c}`" for c, k in kinds)
        self.spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT {nothing} WHERE false")


def whole_days(w: BatchWindow) -> tuple[dt.date, dt.date]:
    """First and last calendar day of a window that starts and ends at
    midnight."""
    lo, hi = dt.datetime.fromisoformat(w.date), dt.datetime.fromisoformat(w.date_next)
    if lo.time() != dt.time(0) or hi.time() != dt.time(0) or hi <= lo:
        raise ValueError(f"the sink replaces whole day partitions; window {w.date}..{w.date_next} is not whole days")
    return lo.date(), (hi - dt.timedelta(days=1)).date()


def _date(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def _cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that a write
    never replaces files its own plan still reads."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _replace(store: Store, table: str, df: DataFrame, parts: list[str], stated: Column, source: tuple[str, str] | None, there: set[tuple] | None = None) -> None:
    """Replace the partitions of ``df``, then empty those that got no rows
    among those ``there``, or that match ``stated`` (and the source)."""
    before = store.read(table) if there is None else None
    there = there or set()
    values = [F.col(p).cast("string").alias(p) for p in parts]
    if before is not None and set(parts) <= set(before.columns):
        cond = stated if source is None else stated & (F.col(source[0]) == source[1])
        there = {tuple(r) for r in before.where(cond).select(*values).distinct().collect()}
    # the values of the partition columns, not rows: days or windows of the batch
    seen = Observation()
    store.replace(table, df.observe(seen, F.collect_set(F.struct(*values)).alias("values")), parts)
    for gone in sorted(there - {tuple(r) for r in seen.get["values"]}, key=repr):
        store.empty(table, df, dict(zip(parts, gone, strict=True)))


def write_days(
    store: Store,
    table: str,
    df: DataFrame,
    first: dt.date,
    last: dt.date,
    day_of: str | None = None,
    source: tuple[str, str] | None = None,
    reads_own_target: bool = False,
    keep_day: bool = False,
) -> None:
    """Replace the days ``first`` to ``last`` of ``table`` by ``df``. Tables
    in ``schemas.PARTITION_BY_HASH`` are parted by that hash too.

    The day is that of the column ``day_of``, or the column ``batch_day`` of
    ``df``. With ``source`` = (column, value), several jobs share the table
    and only that source's rows are replaced. With ``keep_day`` the rows
    already there stay and ``df`` is added."""
    if day_of is not None:
        part = day_partition(day_of)
        df = df.withColumn(part, F.to_date(day_of))
    else:
        part = BATCH_DAY
    if keep_day and (before := store.read(table)) is not None:
        df = before.where(F.col(part).between(_date(first), _date(last))).unionByName(df)
        reads_own_target = True
    if reads_own_target:
        df = _cut(df)
    inside = F.col(part).between(_date(first), _date(last))
    refused = F.raise_error(F.concat(F.lit(f"{table}: the batch replaces {first}..{last}, not "), F.coalesce(F.col(part).cast("string"), F.lit("NULL"))))
    checked = df.withColumn(part, F.when(inside, F.col(part)).otherwise(refused.cast("date")))
    parts = [part] if source is None else [source[0], part]
    if table in PARTITION_BY_HASH:
        checked = with_bucket(checked, table)
        parts.append(PARTITION_BY_HASH[table][0])
    _replace(store, table, checked, parts, inside, source)


def replace_keys(store: Store, table: str, new: DataFrame, keys: DataFrame, on: list[str], parts: list[str], scope: Column, steps: Sequence[Column] = ()) -> None:
    """Among the partitions in ``scope`` (a condition on ``parts``), the rows
    of ``keys`` are replaced by ``new``; partitions without such a row, old or
    new, are neither read whole nor written. ``steps`` (conditions on
    ``parts``) are replaced one after the other."""
    new = _cut(with_bucket(new, table))
    before = store.read(table)
    if before is None:
        store.replace(table, new, parts)
        return
    before = before.where(scope)
    held = join_small(before.select(*on, *parts), keys.select(*on), on, "left_semi")
    touched = _cut(held.select(*parts).unionAll(new.select(*parts)).distinct())
    named = touched.select(*[F.col(p).alias(f"__{p}") for p in parts])
    same = F.lit(True)
    for p in parts:
        same = same & (F.col(p) == F.col(f"__{p}"))
    # a row for each partition in scope at most
    rest = before.join(F.broadcast(named), same, "left_semi")
    merged = _cut(join_small(rest, keys.select(*on), on, "left_anti").unionByName(new))
    for step in steps or (F.lit(True),):
        there = {tuple(r) for r in touched.where(step).select(*[F.col(p).cast("string") for p in parts]).collect()}
        if there:
            _replace(store, table, merged.where(step), parts, step, None, there)


def write_window(store: Store, table: str, df: DataFrame, w: BatchWindow) -> None:
    """Replace the rows of window ``w`` in a table without days."""
    whole_days(w)
    key = f"{w.date[:10]}_{w.date_next[:10]}"
    before = store.read(table)
    if before is not None and BATCH_WINDOW in before.columns:
        lo, hi = (F.split(BATCH_WINDOW, "_").getItem(i) for i in (0, 1))
        clash = before.where((F.col(BATCH_WINDOW) != key) & (lo < w.date_next[:10]) & (hi > w.date[:10])).select(BATCH_WINDOW).limit(1).collect()
        if clash:
            raise ValueError(f"{table}: window {key} overlaps {clash[0][0]}, which is already there")
    _replace(store, table, df.withColumn(BATCH_WINDOW, F.lit(key)), [BATCH_WINDOW], F.col(BATCH_WINDOW) == key, None)


def partition_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in (BATCH_DAY, BATCH_WINDOW) or c.endswith(DAY_SUFFIX)]


def rewrite_partitions(store: Store, table: str, df: DataFrame) -> None:
    """UPDATE: ``df`` holds whole partitions of ``table`` (or, if it has no
    partitions, the whole table) with the changes made. They are checkpointed
    before they are replaced, as they were read from the same files."""
    parts = partition_columns(df)
    out = _cut(df)
    if parts:
        store.replace(table, out, parts)
    else:
        store.replace_all(table, out)
