"""Logical table names -> DataFrames.

Jobs never open files themselves; they ask a ``Tables`` for a logical name
such as ``raw_data.order_logs``. In production the registry resolves names
through the session catalog (``spark.table``); tests and the bundled queries
resolve them to views over the fixture Parquet tables.
"""

from __future__ import annotations

import copy
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.schemas import STATES, TARGETS, empty_table
from tillroll.sources.sinks import CatalogStore, ParquetStore, Store


class Tables:
    def __init__(
        self,
        spark: SparkSession,
        resolvers: Mapping[str, Callable[["Tables"], DataFrame]] | None = None,
        fallback: Callable[[str], DataFrame] | None = None,
    ):
        self.spark = spark
        self._resolvers = dict(resolvers or {})
        self._fallback = fallback
        self._cache: dict[str, DataFrame] = {}

    @classmethod
    def stored(cls, store: Store) -> "Tables":
        """Resolve every name through a store. A target that no job has
        written yet is an empty relation of its schema."""

        def read(name: str) -> DataFrame:
            df = store.read(name)
            if df is None and (name in TARGETS or name in STATES):
                df = empty_table(store.spark, name)
            if df is None:
                raise KeyError(f"no table {name!r}")
            return df

        return cls(store.spark, fallback=read)

    @classmethod
    def catalog(cls, spark: SparkSession) -> "Tables":
        """Resolve every name through the session catalog."""
        return cls.stored(CatalogStore(spark))

    @classmethod
    def warehouse(cls, spark: SparkSession, root: str) -> "Tables":
        """Resolve ``schema.table`` to the Parquet directory ``root/schema.table``
        (the layout ``plans.run.run_job`` writes)."""
        return cls.stored(ParquetStore(spark, root))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in self._resolvers:
                self._cache[name] = self._resolvers[name](self)
            elif self._fallback is not None:
                self._cache[name] = self._fallback(name)
            else:
                raise KeyError(f"no table registered as {name!r}")
        return self._cache[name]

    def __contains__(self, name: str) -> bool:
        return name in self._resolvers or self._fallback is not None

    def override(self, **tables: DataFrame) -> "Tables":
        """A copy in which some names resolve to the given DataFrames; keys
        use ``__`` for the dot (``override(order_center__orders=df)``)."""
        clone = copy.copy(self)
        clone._resolvers = dict(self._resolvers)
        clone._cache = {}
        for key, df in tables.items():
            clone._resolvers[key.replace("__", ".")] = lambda _t, d=df: d
        return clone
