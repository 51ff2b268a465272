"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import ensure_checkpoint_dir

# Fixed value: the white space of the contracts, [\x20\x09-\x0D]; the same
# six bytes that bytes.split() splits on.
WHITE = b" \t\n\x0b\x0c\r"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage
    (reliable storage, so a lost executor loses nothing)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


#: What crosses to a Python worker at a time, where the session does not say:
#: texts are long, and Spark's default of 10,000 rows may be hundreds of MB.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def bound_batches(spark: SparkSession) -> None:
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def id_text(docs: DataFrame) -> DataFrame:
    """The two columns the operators read; every other column, whatever its
    name, is left out of the plan."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def shuffle_partitions(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def unused(name: str, *frames: DataFrame) -> str:
    """``name``, prefixed until no column of ``frames`` has it (column names
    are compared without case, as Spark does)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def code_points(column: pa.Array) -> pa.Array:
    """Code points of each text of a string column; null counts as empty."""
    return pc.utf8_length(column).fill_null(0).cast(pa.int64())
