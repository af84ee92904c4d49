"""Removal of word windows that also start in an earlier document.

Every window of ``window`` consecutive words has a Rabin-Karp hash, a
polynomial over 64-bit word hashes taken from running sums.  A second
polynomial gives ``CHECK`` more bits.  Hashes are counted in Spark:

1. Documents are dealt into batches of about ``BATCH_BYTES`` by a hash of the
   row.  A batch sorts its windows, keeps of equal ones the one of the least
   doc_id, and sends the distinct hashes to buckets by their first bits, as
   sorted differences with the ids they belong to: a window that a third of all
   rows hold is sent once a batch.
2. A bucket finds the least doc_id of each hash over all batches, and answers
   each batch with one bit a hash: it starts in a document of a smaller id, too.
3. The batch, cut again from the same shuffle, marks its windows and joins the
   marked ones to maximal intervals of words.

Two windows count as equal if all 64 + CHECK bits are: of n windows about
n^2 / 2^(65 + CHECK) pairs are equal by accident, 3e-5 at the 8e9 windows of
30 GB.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import documents, text_bytes
from lakeledger.llm.wordhash import SPACE, mix, running, span_hash, spans

CHECK = 16
BATCH_BYTES = 4 << 20   # of text in a batch, on average
BUCKET_BYTES = 8 << 20  # of text whose windows meet in a bucket, on average


def _chunk(column: pa.ChunkedArray) -> pa.Array:
    out = column.combine_chunks()
    return out.chunk(0) if isinstance(out, pa.ChunkedArray) else out


class _Windows:
    """The distinct windows of a batch of documents."""

    def __init__(self, table: pa.Table, window: int):
        order = pc.sort_indices(table, [("doc_id", "ascending")])  # nulls last
        table = table.take(order)
        self.ids = _chunk(table["doc_id"])
        n_ids = len(self.ids) - self.ids.null_count
        self.id = self.ids.slice(0, n_ids).to_numpy(zero_copy_only=False).astype(np.int64)
        self.raw, self.off = text_bytes(_chunk(table["text"]))
        self.start, self.end = spans(self.raw, self.off, SPACE)
        self.at = np.searchsorted(self.start, self.off)
        word = span_hash(running(self.raw), self.start, self.end)
        text = np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))
        last = len(word) - window + 1
        # windows inside one text that has an id
        place = np.flatnonzero((text[:max(last, 0)] == text[window - 1:]) & (text[:max(last, 0)] < n_ids)) if last > 0 else np.zeros(0, np.int64)
        key = span_hash(running(word), place, place + window)
        check = (span_hash(running(mix(word ^ np.uint64(0x5851F42D4C957F2D))), place, place + window) >> np.uint64(64 - CHECK)).astype(np.uint16)
        order = np.argsort(key, kind="stable")  # of equal ones the least id first
        k, c = key[order], check[order]
        if np.any((k[1:] == k[:-1]) & (c[1:] != c[:-1])):
            order = np.lexsort((check, key))
            k, c = key[order], check[order]
        new = np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])][:len(k)]
        self.place, self.group = place[order], np.cumsum(new) - 1
        doc = text[self.place]
        self.key, self.check, self.doc = k[new], c[new], doc[new]
        # in a document after the first one of its batch
        self.later = self.id[doc] > self.id[self.doc][self.group] if len(doc) else np.zeros(0, bool)

    def buckets(self, bits: int) -> np.ndarray:
        """The buckets' offsets into the distinct windows."""
        if not bits:
            return np.array([0, len(self.key)])
        return np.searchsorted(self.key >> np.uint64(64 - bits), np.arange((1 << bits) + 1).astype(np.uint64))


def _planes(x: np.ndarray) -> bytes:
    """Numbers by bytes of equal weight: the high ones are nearly all zero."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def _numbers(data: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def _sent(batch: int, w: _Windows, bits: int) -> pa.Table:
    """One row for each bucket that the batch has windows for."""
    cut = w.buckets(bits)
    rows = {"bucket": [], "batch": [], "n": [], "keys": [], "checks": [], "docs": [], "ids": []}
    for b in np.flatnonzero(np.diff(cut)).tolist():
        lo, hi = cut[b], cut[b + 1]
        used, doc = np.unique(w.doc[lo:hi], return_inverse=True)
        rows["bucket"].append(b)
        rows["batch"].append(batch)
        rows["n"].append(int(hi - lo))
        rows["keys"].append(_planes(np.diff(w.key[lo:hi], prepend=np.uint64(0))))
        rows["checks"].append(w.check[lo:hi].tobytes())
        rows["docs"].append(_planes(doc.astype(np.uint32)))
        rows["ids"].append(_planes(np.diff(w.id[used], prepend=0)))
    return pa.table(rows, schema=pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("n", pa.int64()),
                                            *[(c, pa.binary()) for c in ("keys", "checks", "docs", "ids")]]))


def _answers(table: pa.Table) -> pa.Table:
    """Of one bucket: for each batch a bit a window, where one is set."""
    rows = table.to_pylist()
    key = np.concatenate([np.cumsum(_numbers(r["keys"], r["n"], np.uint64), dtype=np.uint64) for r in rows])
    check = np.concatenate([np.frombuffer(r["checks"], np.uint16) for r in rows])
    ids = []
    for r in rows:
        have = np.cumsum(_numbers(r["ids"], len(r["ids"]) // 8, np.int64))
        ids.append(have[_numbers(r["docs"], r["n"], np.uint32)])
    ids = np.concatenate(ids)
    order = np.argsort(key, kind="stable")
    k, c = key[order], check[order]
    if np.any((k[1:] == k[:-1]) & (c[1:] != c[:-1])):
        order = np.lexsort((check, key))
        k, c = key[order], check[order]
    first = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
    least = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.r_[first, len(k)]))
    flag = np.zeros(len(key), bool)
    flag[order] = ids[order] > least
    at, out = 0, {"batch": [], "bucket": [], "bits": []}
    for r in rows:
        own = flag[at:at + r["n"]]
        at += r["n"]
        if own.any():
            out["batch"].append(r["batch"])
            out["bucket"].append(r["bucket"])
            out["bits"].append(np.packbits(own).tobytes())
    return pa.table(out, schema=pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary())]))


def _removed(w: _Windows, answers: pa.Table, bits: int, window: int) -> pa.Table:
    """The documents of a batch with their removed intervals."""
    flag, cut = np.zeros(len(w.key), bool), w.buckets(bits)
    for r in answers.to_pylist():
        lo, hi = cut[r["bucket"]], cut[r["bucket"] + 1]
        flag[lo:hi] = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=int(hi - lo))
    gone = w.place[w.later | flag[w.group]] if len(w.group) else w.place
    edge = np.zeros(len(w.start) + 1, np.int64)
    np.add.at(edge, gone, 1)
    np.add.at(edge, gone + window, -1)
    keep = np.cumsum(edge[:-1]) == 0
    # runs of words that go, cut at the ends of texts
    border = np.zeros(len(keep) + 1, bool)
    border[w.at] = True
    first = np.flatnonzero(~keep & (border[:-1] | np.r_[True, keep[:-1]][:len(keep)]))
    last = np.flatnonzero(~keep & (border[1:] | np.r_[keep[1:], True][:len(keep)])) + 1
    per = np.searchsorted(first, w.at)
    base = np.repeat(w.at[:-1], np.diff(per))
    data, kept = w.raw.tobytes(), []
    for i, (a, b) in enumerate(zip(w.off[:-1].tolist(), w.off[1:].tolist(), strict=True)):
        words = data[a:b].split()
        if per[i + 1] > per[i]:
            words = [x for x, k in zip(words, keep[w.at[i]:w.at[i + 1]].tolist(), strict=True) if k]
        kept.append(b" ".join(words))
    each = pa.StructArray.from_arrays([pa.array(first - base), pa.array(last - base)], ["start", "end"])
    return pa.table([w.ids, pa.array(np.diff(w.at).astype(np.int64)), pa.ListArray.from_arrays(pa.array(per.astype(np.int32)), each),
                     pa.array(kept, pa.string())], names=["doc_id", "n_words", "removed", "kept_text"])


def drop_repeated_windows(docs: DataFrame, window: int = 50, batch_bytes: int = BATCH_BYTES,
                          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_words, removed, kept_text) for every row: ``removed`` lists
    the maximal intervals [start, end) of words covered by a window whose words
    also start in a row with a smaller doc_id; ``kept_text`` has the other
    words, joined by one space.

    Words are runs of bytes other than ASCII white space, unchanged.  Null and
    empty texts have no words.  Rows that share a doc_id take nothing from one
    another; a row with a null doc_id neither loses words nor makes others
    lose them.  An empty table gives an empty result; other columns are ignored.
    """
    docs = documents(docs)
    total = int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    batches = -(-total // batch_bytes) or 1
    bits = max(0, (total // bucket_bytes).bit_length())
    rows = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))

    # without type hints, by which Spark would choose among its variants
    def send(key, table):
        return _sent(key[0].as_py(), _Windows(table, window), bits)

    def answer(table):
        return _answers(table)

    def remove(left, right):
        return _removed(_Windows(left, window), right, bits, window)

    grouped = rows.groupBy("batch")
    sent = grouped.applyInArrow(send, "bucket int, batch long, n long, keys binary, checks binary, docs binary, ids binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "batch long, bucket int, bits binary")
    return grouped.cogroup(answers.groupBy("batch")).applyInArrow(
        remove, "doc_id long, n_words long, removed array<struct<start:long,end:long>>, kept_text string")
