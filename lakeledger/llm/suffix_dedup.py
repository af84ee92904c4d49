"""Removal of repeated substrings by suffix order, exact over the whole corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
elsewhere, in its own text or another.

No machine holds the suffix array of a corpus, so equal strings are brought
together first.  Of the ``SEED``-byte pieces in a window of LENGTH bytes the one
with the least hash is the window's seed (the first of equals).  It depends on
the window's bytes alone, so equal windows have equal seeds at equal places.
Neighbouring windows mostly share their seed, and the stretch of text that they
cover is a region; each window is in one region.  Seeds that occur once cannot
have repeated windows and are dropped.  Regions equal in bytes and place are
folded to one with a count: all their windows are repeated.  Where a seed has
regions of several shapes, their texts are brought together by the seed and
sorted: ``induced.suffixes`` gives the suffix order with common prefixes, and a
run of suffixes with common prefixes of LENGTH or more that stand at two or
more places in the corpus is repeated.  So every repeated window is found and
no other.

A passage that a third of all texts share has seeds with that many regions.
Regions that are equal fold before the shuffle.  A seed with more than ``HOT``
shapes is cut again with seeds half way to the whole window, until seeds are
the windows themselves; longer seeds reach into what differs.  Tasks sort a
bounded number of bytes at a time (or one seed's, at most HOT regions).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import drop_caches, slices, stored, text_bytes, wide
from lakeledger.llm.induced import CAP, suffixes
from lakeledger.llm.wordhash import mix, running, span_hash

LENGTH = 200
SEED = 64
HOT = 4096
SORT_BYTES = 1 << 20   # region bytes sorted at a time; each takes some 150 bytes of memory
SLICE = 1 << 19        # windows looked at in one step
PLACE_BITS = 20


def _least(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    return np.minimum(key[:len(key) - (width - have)], key[width - have:]) if have < width else key


def regions(sums: np.ndarray, off: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the seed, first and last window) of the regions of the texts."""
    width, n = length - seed + 1, int(off[-1])
    end = np.repeat(off[1:], np.diff(off))
    low = np.uint64((1 << PLACE_BITS) - 1)
    out = [np.zeros((0, 3), np.int64)]
    for a in range(0, max(0, n - length + 1), SLICE):
        b = min(n - length + 1, a + SLICE)
        window = np.arange(a, b)
        window = window[window + length <= end[a:b]]  # those inside one text
        if not len(window):
            continue
        at = np.arange(a, b + width - 1)
        key = (span_hash(sums, at, at + seed) & ~low) | np.arange(len(at), dtype=np.uint64)
        place = (_least(key, width)[window - a] & low).astype(np.int64) + a
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (window[1:] != window[:-1] + 1)])
        last = np.r_[new[1:] - 1, len(window) - 1]
        out.append(np.c_[place[new], window[new], window[last]])
    found = np.concatenate(out)
    if len(found) > 1:  # a region that a step cut in two
        joins = (found[1:, 0] == found[:-1, 0]) & (found[1:, 1] == found[:-1, 2] + 1)
        first = np.flatnonzero(np.r_[True, ~joins])
        found = np.c_[found[first, :2], found[np.r_[first[1:] - 1, len(found) - 1], 2]]
    return found[:, 0], found[:, 1], found[:, 2]


def _row_key() -> list[Column]:
    """A 64-bit name of a row's id and text, and eight more bits of the id."""
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return [F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))).alias("row"),
            F.coalesce(F.col("doc_id").cast("long").bitwiseAND(F.lit(255)), F.lit(0)).cast("int").alias("tag"), text]


_REGION = "seed long, shape long, row long, place long"


def _pack(lo: np.ndarray, tag: np.ndarray, windows: np.ndarray) -> np.ndarray:
    return lo << 16 | tag << 8 | (windows - 1)


def _lo(place: Column) -> Column:
    return F.shiftright(place, 16)


def _tag(place: Column) -> Column:
    return F.shiftright(place, 8).bitwiseAND(F.lit(255)).cast("int")


def _windows(place: Column) -> Column:
    return place.bitwiseAND(F.lit(255)) + 1


def corpus_regions(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """(seed, shape, row, place) of the regions of all texts; shape is a hash
    of a region's bytes and of the place of its seed in it."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        for b in slices(batches, 256):
            raw, off = text_bytes(b.column(2))
            sums = running(raw)
            at, first, last = regions(sums, off, length, seed)
            doc = np.searchsorted(off, at, "right") - 1
            shape = span_hash(sums, first, last + length) ^ mix((at - first).astype(np.uint64))
            tag = b.column(1).to_numpy()[doc].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(span_hash(sums, at, at + seed).view(np.int64)), pa.array(shape.view(np.int64)),
                 b.column(0).take(pa.array(doc)), pa.array(_pack(first - off[doc], tag, last - first + 1))],
                ["seed", "shape", "row", "place"])

    rows = docs.select(*_row_key()).where(F.octet_length("text") >= length)
    return wide(rows).mapInArrow(each, _REGION)


_TEXTS = "seed long, shape long, row long, place long, n long, bytes binary"


def _fetch(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted regions (seed, shape, row, place, n) with their bytes."""
    lists = wanted.groupBy("row", _tag(F.col("place")).alias("tag")).agg(
        F.collect_list(F.struct("seed", "shape", "place", "n")).alias("r"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            raw, off = text_bytes(b.column(1))
            lists = b.column(2)
            one = lists.flatten()
            doc = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            place = one.field(2).to_numpy()
            lo = off[doc] + (place >> 16)
            data, parts = raw.tobytes(), (place & 255) + length
            yield pa.RecordBatch.from_arrays(
                [one.field(0), one.field(1), b.column(0).take(pa.array(doc)), one.field(2), one.field(3),
                 pa.array([data[s:s + k] for s, k in zip(lo.tolist(), parts.tolist(), strict=True)], pa.binary())],
                ["seed", "shape", "row", "place", "n", "bytes"])

    rows = docs.select(*_row_key()).where(F.octet_length("text") >= length)
    return rows.join(lists, ["row", "tag"]).select("row", "text", "r").mapInArrow(each, _TEXTS)


def _cut_again(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """The regions of regions for a longer seed, folded, without those whose
    seed occurs once."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2048):
            raw, off = text_bytes(b.column(5))
            sums = running(raw)
            at, first, last = regions(sums, off, length, seed)
            doc = np.searchsorted(off, at, "right") - 1
            shape = span_hash(sums, first, last + length) ^ mix((at - first).astype(np.uint64))
            place = b.column(3).to_numpy()[doc]
            data = raw.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array((span_hash(sums, at, at + seed) + np.uint64(seed)).view(np.int64)),
                 pa.array(shape.view(np.int64)), b.column(2).take(pa.array(doc)),
                 pa.array(_pack((place >> 16) + first - off[doc], place >> 8 & 255, last - first + 1)),
                 b.column(4).take(pa.array(doc)),
                 pa.array([data[s:e] for s, e in zip(first.tolist(), (last + length).tolist(), strict=True)],
                          pa.binary())], ["seed", "shape", "row", "place", "n", "bytes"])

    return texts.mapInArrow(each, _TEXTS)


def _sort_regions(texts: DataFrame, length: int) -> DataFrame:
    """(row, place, a, b): of the regions that occur once, the windows a..b
    that are repeated elsewhere."""
    def repeated(seed, n, row, place, parts) -> pa.RecordBatch:
        size = np.array([len(p) for p in parts], np.int64)
        text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8)
        start = np.cumsum(size + 1) - size - 1
        order, lcp = suffixes(text)
        of = np.repeat(np.arange(len(parts)), size + 1)
        inner = np.arange(len(text)) - start[of]
        window = inner <= (size - length)[of]
        # classes of equal windows: runs of long common prefixes
        group = np.cumsum(lcp < length)
        mine = window[order]
        order, group = order[mine], group[mine]
        where = row.view(np.uint64)[of] + ((place >> 16)[of] + inner).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        w, many = where[order], n[of[order]] > 1
        again = (np.minimum.reduceat(w, head) != np.maximum.reduceat(w, head)) | np.logical_or.reduceat(many, head)
        hit = np.zeros(len(text), bool)
        hit[order] = np.repeat(again, np.diff(np.r_[head, len(order)]))
        hit &= (n == 1)[of]
        a = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])
        b = np.flatnonzero(hit & ~np.r_[hit[1:], False])
        return pa.RecordBatch.from_arrays(
            [pa.array(row[of[a]]), pa.array(place[of[a]]), pa.array(inner[a]), pa.array(inner[b])],
            ["row", "place", "a", "b"])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_caches()
        held, count = [], 0
        for batch in slices(batches, 2000):
            held.append(batch)
            count += batch.column("bytes").nbytes
            if count < SORT_BYTES:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            seed = whole.column(0).to_numpy()
            cut = int(np.flatnonzero(seed != seed[-1]).max(initial=-1)) + 1  # the last seed may go on
            if cut:
                yield from run(whole.slice(0, cut))
            held, count = [whole.slice(cut)], whole.slice(cut).column("bytes").nbytes if cut else 0
        if held:
            yield from run(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seed = b.column(0).to_numpy()
        # in parts of bounded size that end with a seed
        size = np.cumsum(np.diff(text_bytes(b.column(5))[1]) + 1)
        ends = np.flatnonzero(np.r_[seed[1:] != seed[:-1], True]) + 1
        at = 0
        while at < b.num_rows:
            done = size[at - 1] if at else 0
            fits = ends[(ends > at) & (size[ends - 1] - done <= SORT_BYTES)]
            to = int(fits[-1]) if len(fits) else int(ends[ends > at][0])
            part = b.slice(at, to - at)
            yield repeated(seed[at:to], part.column(4).to_numpy(), part.column(2).to_numpy(),
                           part.column(3).to_numpy(), part.column(5).to_pylist())
            at = to

    ordered = texts.repartition("seed").sortWithinPartitions("seed")
    return ordered.mapInArrow(each, "row long, place long, a long, b long")


def repeated_spans(docs: DataFrame, length: int = LENGTH, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """(row, tag, spans): the byte spans [a, b) of a row that repeated strings
    cover, unmerged."""
    if not 0 < seed <= length or length - seed + 1 > 256:
        raise ValueError("seeds must be at most as long as the strings, and shorter by 255 bytes at most")
    if length > CAP:
        raise ValueError(f"common prefixes are known up to {CAP} bytes: no longer strings can be found")
    many = corpus_regions(docs, length, seed).groupBy("seed").agg(F.count("*").alias("k")).where("k > 1")
    found = stored(corpus_regions(docs, length, seed).join(many, "seed", "left_semi"), "regions")
    shapes = stored(found.groupBy("seed", "shape").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one"))
        .select("seed", "shape", "n", "one.*"), "shapes")
    folded = found.join(shapes.where("n > 1").select("seed", "shape"), ["seed", "shape"], "left_semi")
    whole = [folded.select("row", _tag(F.col("place")).alias("tag"), _lo(F.col("place")).alias("a"),
                           (_lo(F.col("place")) + _windows(F.col("place")) - 1 + length).alias("b"))]
    # seeds with one shape are done; a shape that occurs once needs another one
    per_seed = shapes.groupBy("seed").agg(F.count("*").alias("k")).where("k > 1")
    texts = _fetch(docs, shapes.join(per_seed.select("seed"), "seed", "left_semi"), length)
    is_hot = per_seed.where(F.col("k") > hot).select("seed")
    parts = []
    while not is_hot.isEmpty() and seed < length:
        texts = stored(texts, "texts")
        parts.append(texts.join(is_hot, "seed", "left_anti"))
        seed = (seed + length + 1) // 2
        again = stored(_cut_again(texts.join(is_hot, "seed", "left_semi"), length, seed), "texts")
        shapes = again.groupBy("seed", "shape").agg(F.sum("n").alias("n"), F.count("*").alias("k"),
                                                    F.min(F.struct("row", "place", "bytes")).alias("one"))
        shapes = stored(shapes.select("seed", "shape", "n", "k", "one.*"), "shapes")
        # folded regions: every row of them is repeated; those that stood for
        # several rows before were counted whole then
        same = again.join(shapes.where("k > 1").select("seed", "shape"), ["seed", "shape"], "left_semi").where("n = 1")
        whole.append(same.select("row", _tag(F.col("place")).alias("tag"), _lo(F.col("place")).alias("a"),
                                 (_lo(F.col("place")) + _windows(F.col("place")) - 1 + length).alias("b")))
        per_seed = shapes.groupBy("seed").agg(F.count("*").alias("k")).where("k > 1")
        texts = (shapes.join(per_seed.select("seed"), "seed", "left_semi")
                 .select("seed", "shape", "row", "place", "n", "bytes"))
        is_hot = per_seed.where(F.col("k") > hot).select("seed")
    parts.append(texts)
    joined = parts[0]
    for p in parts[1:]:
        joined = joined.unionByName(p)
    single = _sort_regions(joined, length)
    spans = single.select("row", _tag(F.col("place")).alias("tag"), (_lo(F.col("place")) + F.col("a")).alias("a"),
                          (_lo(F.col("place")) + F.col("b") + length).alias("b"))
    for w in whole:
        spans = spans.unionByName(w)
    return spans.groupBy("row", "tag").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def _merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that overlap or touch become one."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.r_[True, a[1:] > b[:-1]]
    return a[new], b[np.r_[np.flatnonzero(new)[1:] - 1, len(b) - 1]]


def deduplicate(docs: DataFrame, keep: list[str], length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """The columns ``keep`` and n_bytes, n_removed, n_spans, kept_sha256 of
    every row, with ``with_text`` also kept_text: what is left of the text,
    without the incomplete characters at the cuts.

    Null text is empty.  Texts shorter than ``length`` bytes keep all.  Repeated
    rows and rows with a null doc_id are texts like any other: a row that is
    there twice has each of its strings twice.  An empty table gives an empty
    result.
    """
    spans = repeated_spans(docs, length)
    key, tag, text = _row_key()
    named = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    rows = docs.select(*named, key.alias("_row"), tag.alias("_tag"), text.alias("_text"))
    both = rows.join(spans, (F.col("_row") == spans["row"]) & (F.col("_tag") == spans["tag"]), "left")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            texts = b.column(0).cast(pa.binary()).to_pylist()
            lists = b.column(1).to_pylist()
            size, removed, count, digest, left = [], [], [], [], []
            for t, sp in zip(texts, lists, strict=True):
                kept, gone, n = t, 0, 0
                if sp:
                    x = np.array([(s["a"], s["b"]) for s in sp], np.int64)
                    lo, hi = _merged(x[:, 0], x[:, 1])
                    gone, n = int((hi - lo).sum()), len(lo)
                    kept = b"".join(t[s:e] for s, e in zip([0, *hi.tolist()], [*lo.tolist(), len(t)], strict=True))
                size.append(len(t))
                removed.append(gone)
                count.append(n)
                digest.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    left.append(kept.decode("utf-8", "ignore"))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[2:], pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(count, pa.int64()), pa.array(digest, pa.string()),
                 *([pa.array(left, pa.string())] if with_text else [])],
                [*[f"_k{i}" for i in range(len(keep))], "n_bytes", "n_removed", "n_spans", "kept_sha256",
                 *(["kept_text"] if with_text else [])])

    kinds = "".join(f"_k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    out = both.select("_text", "spans", *[f"_k{i}" for i in range(len(keep))]).mapInArrow(
        each, kinds + "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + (", kept_text string" if with_text else ""))
    return out.withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)})
