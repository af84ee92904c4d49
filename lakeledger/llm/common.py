"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.session import conf_scope, new_run_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    here, and a lost executor costs a re-read instead of a re-run."""
    path = new_run_dir(df.sparkSession, label) + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession):
    """Inside this block 1,000 rows go to a Python worker at once: at the
    default of 10,000 whole documents a batch takes some 35 MB on either side."""
    return conf_scope(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"})


def documents(df: DataFrame) -> DataFrame:
    """(doc_id, text) of a documents table, null text as the empty text.
    Other columns are dropped here, so their names cannot clash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text"), F.lit("")).alias("text"))


def wide(df: DataFrame) -> DataFrame:
    """Deal rows over at least two tasks a core when the scan gives fewer
    tasks; larger inputs already come in more splits and stay as they are."""
    want = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() * 4 < want else df


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def size_slices(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts in ``column`` have about ``most``
    bytes; a longer text comes alone or with shorter ones before it."""
    for b in batches:
        ends = text_bytes(b.column(column))[1][1:]
        at = 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield b.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, concatenated, and the n + 1 row
    offsets into them.  Nulls must have been replaced before."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(column) else raw[:0], off - off[0]


def process_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    import pyspark
    return pyspark.__dict__.setdefault("_lakeledger_cache", {}).setdefault(name, {})


def drop_caches() -> None:
    """Empty the worker's caches: Spark reuses workers, and a task of another
    operator should not find its memory taken."""
    import pyspark
    for cache in pyspark.__dict__.get("_lakeledger_cache", {}).values():
        cache.clear()
