"""Token files: Parquet with one row a document and its ids as a list column.

Layout, all by Spark's own Parquet writer: rows in ascending doc_id order
over the files in name order; format version 2, so that doc_id, n_tokens and
local_start are delta-encoded; the ids dictionary-encoded (a page of codes
needs 16 bits an id for a vocabulary of 50,000); row groups of
``ROW_GROUP_BYTES`` and pages of ``PAGE_BYTES`` with column and offset indexes.
A reader of the metadata columns reads no ids, and one that asks for a few
doc_ids reads only the pages that hold them.

The place of a document in the whole stream is not stored per file, as no
task knows what the files before it hold: a file has ``shard`` and
``local_start``, and the reader adds the totals of the shards before, which it
takes from the n_tokens column alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeledger.llm.common import documents, slices, small_batches
from lakeledger.llm.tokens import encoder

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 64 << 10
BATCH = 256
MEMO = 420_000  # pieces of a generation: the file writers need the memory, too

OPTIONS = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": "2000",
    "compression": "snappy",
}


def list_array(flat: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, kind: str, end_id: int) -> None:
    """Encode every whole text, append ``end_id`` and write the files.

    Null text: no ids but the end id.  Rows with a null doc_id come first;
    rows that share a doc_id are ordered by a hash of the text, and repeated
    rows are kept.  An empty table writes files without rows.  Other columns
    are not written.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = encoder(tokenizer, kind, MEMO), 0
        shard = TaskContext.get().partitionId()
        for b in slices(batches, BATCH):
            flat, off = enc.encode(b.column(1).to_pylist(), end_id)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(b.num_rows, shard, np.int32)), pa.array(at + off[:-1]),
                 pa.array(np.diff(off)), list_array(flat, off)],
                ["doc_id", "shard", "local_start", "n_tokens", "ids"])
            at += int(off[-1])

    rows = documents(docs).withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    with small_batches(docs.sparkSession):
        (rows.mapInArrow(each, "doc_id long, shard int, local_start long, n_tokens long, ids array<int>")
         .write.options(**OPTIONS).parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of token files; start counts the ids of
    all documents before."""
    files = spark.read.schema("doc_id long, shard int, local_start long, n_tokens long, ids array<int>").parquet(path)
    # one row a file: bounded by the number of tasks that wrote
    before = (files.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
              .select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before")))
    return (files.join(F.broadcast(before), "shard")
            .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids"))


def crc_of(flat: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(flat, "<u4").data)


def with_crc(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32); n_tokens counted from the ids."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(2)
            flat, off = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            crc = [crc_of(flat[s:e]) for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(
        each, "doc_id long, start long, n_tokens long, ids_crc32 long")
