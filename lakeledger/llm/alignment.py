"""Cross-tokenizer alignment: which ids of two tokenizers stand for the same
bytes, counted over a corpus by inverted bitmaps.

1. Texts are encoded and aligned (``aligner``).  The documents of a task get
   numbers in blocks of 65,536.  For each pair of linked ids a part of a block
   has a compressed bitmap of the documents that hold the pair (plane 0), and
   one for each bit of (times linked - 1) in a document (planes 1, 2, ...).
2. The parts of a (pair, block, plane) are OR-merged and popcounted: the
   index.  Popcounts of plane 0 sum to the documents of a pair, those of all
   planes, by their weights, to its links.
3. The postings return scores: each row of the index meets its pair's counts,
   goes to its block, and adds them to the block's documents.

A bitmap is a byte string: 0 and sorted 16-bit numbers, or 1, the first byte's
number (16 bits) and the bytes from there to the last one with a bit set,
whichever is shorter.  A pair that every document holds has one row a block, so
no row, key or task grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.aligner import aligner
from lakeledger.llm.common import documents, size_slices, small_batches, stored, text_bytes, wide
from lakeledger.session import new_run_dir

BLOCK_BITS = 16
PART_BYTES = 4 << 20         # of text whose bitmaps are made at once
NUMBERS = 1 << 20            # of bitmaps that are unpacked at once; one row may have more
BROADCAST_PAIRS = 1_000_000  # counted pairs (of 17 bytes) up to which they are broadcast


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


def to_bitmaps(size: np.ndarray, pos: np.ndarray) -> pa.Array:
    """Bitmaps of ``size`` sorted numbers each, all in ``pos``; none is empty."""
    ends = np.cumsum(size)
    first = ends - size
    low, high = pos[first] >> 3, pos[ends - 1] >> 3
    dense = 2 + high - low + 1 < 2 * size
    width = 1 + np.where(dense, 2 + high - low + 1, 2 * size)
    off = np.r_[0, np.cumsum(width)]
    out = np.zeros(off[-1], np.uint8)
    out[off[:-1]] = dense
    row = np.repeat(np.arange(len(size)), size)
    sparse = ~dense[row]
    at = off[:-1][row] + 1 + 2 * (np.arange(len(pos)) - first[row])
    out[at[sparse]], out[at[sparse] + 1] = pos[sparse] & 255, pos[sparse] >> 8
    head = off[:-1][dense]
    out[head + 1], out[head + 2] = low[dense] & 255, low[dense] >> 8
    r, p = row[~sparse], pos[~sparse]
    np.bitwise_or.at(out, off[r] + 3 + (p >> 3) - low[r], (1 << (p & 7)).astype(np.uint8))
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(out)])


def from_bitmaps(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, number) of all numbers of bitmaps."""
    raw, off = text_bytes(column)
    rows, start, width = np.arange(len(column)), off[:-1], np.diff(off)
    dense = raw[start] == 1 if len(column) else np.zeros(0, bool)
    n = (width[~dense] - 1) // 2
    at = _ranges(start[~dense] + 1, 2 * n)
    pair = raw[at].reshape(-1, 2).astype(np.int64)
    row, pos = [np.repeat(rows[~dense], n)], [pair[:, 0] | pair[:, 1] << 8]
    if dense.any():
        s = start[dense]
        first = raw[s + 1].astype(np.int64) | raw[s + 2].astype(np.int64) << 8
        size = width[dense] - 3
        bits = np.flatnonzero(np.unpackbits(raw[_ranges(s + 3, size)], bitorder="little"))
        byte = np.repeat(np.arange(len(size)), size)[bits >> 3]
        begin = np.cumsum(size) - size
        row.append(rows[dense][byte])
        pos.append((first[byte] + (bits >> 3) - begin[byte]) * 8 + (bits & 7))
    return np.concatenate(row), np.concatenate(pos)


def most_numbers(column: pa.Array) -> np.ndarray:
    """The numbers that bitmaps can hold at most."""
    raw, off = text_bytes(column)
    width = np.diff(off)
    return np.where(raw[off[:-1]] == 1, 8 * (width - 3), (width - 1) // 2) if len(column) else width


def _bounded(b: pa.RecordBatch, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices whose ``numbers`` sum to at most NUMBERS."""
    ends = np.cumsum(numbers)
    at = 0
    while at < b.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + NUMBERS, "right")))
        yield b.slice(at, to - at)
        at = to


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The n + 1 offsets of lists into their values, and these."""
    off = column.offsets.to_numpy().astype(np.int64)
    return off - off[0], column.values.slice(off[0], off[-1] - off[0])


def part_numbers(column: pa.Array) -> np.ndarray:
    """The same of lists of bitmaps."""
    off, parts = _lists(column)
    return np.diff(np.r_[0, np.cumsum(most_numbers(parts))][off])


_PART = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("pos", pa.int32()), ("doc_id", pa.int64()),
                   ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                   ("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()), ("bits", pa.binary())])
_DDL = ("kind int, block long, pos int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, pair long, plane int, bits binary")


def _rows(n: int, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _PART], schema=_PART)


def _const(n: int, value: int, kind) -> pa.Array:
    return pa.array(np.full(n, value), kind)


def _postings(block: int, pos: np.ndarray, pair: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The planes of the pairs in one part of a block; ``pos`` is the
    document's number in the block of each link."""
    key, number = np.unique(pair, return_inverse=True)
    entry, times = np.unique(number.astype(np.int64) << BLOCK_BITS | pos, return_counts=True)
    extra, plane, now = times - 1, 0, entry
    while True:
        if len(now):
            size = np.bincount(now >> BLOCK_BITS, minlength=len(key))
            have = np.flatnonzero(size)
            n = len(have)
            yield _rows(n, kind=_const(n, 1, pa.int32()), block=_const(n, block, pa.int64()), pair=pa.array(key[have]),
                        plane=_const(n, plane, pa.int32()), bits=to_bitmaps(size[have], now & ((1 << BLOCK_BITS) - 1)))
        entry, extra = entry[extra > 0], extra[extra > 0]
        if not len(entry):
            return
        plane, now, extra = plane + 1, entry[extra & 1 == 1], extra >> 1


class Alignment(NamedTuple):
    documents: DataFrame  # block, pos, doc_id, n_a, n_b, n_groups, n_links, groups_sha256
    index: DataFrame      # pair, block, plane, n, bits: OR-merged bitmaps
    pairs: DataFrame      # pair (A id << 32 | B id), n_docs, n_links, best


def align(docs: DataFrame, a_path: str, b_path: str) -> Alignment:
    """The alignment of every row's text under a byte-level tokenizer A and a
    sentencepiece model B (see ``aligner`` for the kinds), stored in the shared
    folder.

    Both encode a space and the text, special strings as plain text.  Null and
    empty texts, and those whose bytes are not the same in A, B and the text,
    have zeros, no links, and '' as the hash of their groups.  Each row is a
    document, repeated rows too; a null doc_id stays null; an empty table gives
    empty tables; other columns are ignored.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, at = aligner(a_path, b_path), 0
        task = TaskContext.get().partitionId() << 32
        for big in size_slices(batches, 1, PART_BYTES):
            while big.num_rows:
                b = big.slice(0, (1 << BLOCK_BITS) - (at & ((1 << BLOCK_BITS) - 1)))  # a part lies in one block
                big = big.slice(b.num_rows)
                block, n = task | at >> BLOCK_BITS, b.num_rows
                place = (at & ((1 << BLOCK_BITS) - 1)) + np.arange(n)
                at += n
                counts, sha, doc, pair = tool.documents(b.column(1).to_pylist())
                yield _rows(n, kind=_const(n, 0, pa.int32()), block=_const(n, block, pa.int64()),
                            pos=pa.array(place.astype(np.int32)), doc_id=b.column(0),
                            **{c: pa.array(counts[:, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                            groups_sha256=pa.array(sha, pa.string()))
                yield from _postings(block, place[doc], pair)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for big in batches for x in _bounded(big, part_numbers(big.column(3)))):
            off, parts = _lists(b.column(3))
            part, pos = from_bitmaps(parts)
            row = np.searchsorted(off, part, "right") - 1
            entry = np.unique(row << BLOCK_BITS | pos)
            size = np.bincount(entry >> BLOCK_BITS, minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(size), to_bitmaps(size, entry & ((1 << BLOCK_BITS) - 1))],
                ["pair", "block", "plane", "n", "bits"])

    path = new_run_dir(docs.sparkSession, "alignment") + "/parts"
    with small_batches(docs.sparkSession):
        wide(documents(docs)).mapInArrow(scan, _DDL).write.partitionBy("kind").parquet(path)
    parts = docs.sparkSession.read.schema(_DDL).parquet(path)
    rows = parts.where("kind = 0").select(*[c for c in _PART.names if c not in ("kind", "pair", "plane", "bits")])
    # a (pair, block, plane) has as many parts as its block, whatever the corpus
    index = stored(parts.where("kind = 1").groupBy("pair", "block", "plane").agg(F.collect_list("bits").alias("parts"))
                   .mapInArrow(merge, "pair long, block long, plane int, n long, bits binary"), "pairindex")
    held = F.when(F.col("plane") == 0, F.col("n"))
    pairs = index.groupBy("pair").agg(F.sum(held).alias("n_docs"), F.sum(F.expr("n * shiftleft(1L, greatest(plane - 1, 0))")).alias("n_links"))
    top = pairs.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n_docs").alias("most"))
    pairs = (pairs.join(top, F.shiftright(pairs["pair"], 32) == top["a"])
             .select("pair", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best")))
    return Alignment(rows, index, stored(pairs, "pairs"))


def score(found: Alignment) -> DataFrame:
    """The documents of an alignment with n_best (links whose pair has the most
    documents among those of its A id) and count_sum (the documents of a
    link's pair, over all links)."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, total = None, None, None

        def out() -> Iterator[pa.RecordBatch]:
            if now is not None:
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), now)), pa.array(at.astype(np.int32)),
                                                  pa.array(best[at]), pa.array(total[at])],
                                                 ["block", "pos", "n_best", "count_sum"])

        for b in (x for big in batches for x in _bounded(big, most_numbers(big.column(2)))):
            block = b.column(0).to_numpy()
            times = np.int64(1) << np.maximum(b.column(1).to_numpy().astype(np.int64) - 1, 0)
            weight = times * b.column(3).to_numpy()
            liked = np.where(b.column(4).to_numpy(zero_copy_only=False), times, 0)
            row, pos = from_bitmaps(b.column(2))
            order = np.argsort(row, kind="stable")
            row, pos = row[order], pos[order]
            edge = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if block[lo] != now:
                    yield from out()
                    now, best, total = int(block[lo]), *np.zeros((2, 1 << BLOCK_BITS), np.int64)
                i, j = np.searchsorted(row, [lo, hi])
                np.add.at(total, pos[i:j], weight[row[i:j]])
                np.add.at(best, pos[i:j], liked[row[i:j]])
        yield from out()

    pairs = found.pairs.select("pair", "n_docs", "best")
    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    back = (found.index.join(pairs, "pair").select("block", "plane", "bits", "n_docs", "best")
            .repartition("block").sortWithinPartitions("block")
            .mapInArrow(each, "block long, pos int, n_best long, count_sum long"))
    return (found.documents.join(back, ["block", "pos"], "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
