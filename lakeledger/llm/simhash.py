"""SimHash near-duplicates: fingerprints joined on a segment-popcount grid.

The 64 bits are cut into 32 segments of two bits.  The vector of their bit
counts is a short embedding of the fingerprint, and the Manhattan distance of
two such vectors is a lower bound of the Hamming distance.  So a range join
of the vectors finds every linked pair, and an exact check of the bits
removes the rest.

The range join is a grid join.  The vector is cut into bands, one for every
two bits of allowed distance (two bands at three bits): in one of the bands
two linked vectors are at most 1 apart.  A band is cut into four groups of
segments; vectors at most 1 apart agree in three of them.  A grid cell is
therefore (band, group left out, counts in the other groups), each vector
lies in four cells a band, and linked vectors share a cell.

Copies are folded first: the join runs over distinct fingerprints, so a text
that a third of the corpus repeats is one row.  Cells are joined in blocks
(``pairs.cell_links``), which give a spanning forest of the links in a block,
never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import documents, stored, wide
from lakeledger.llm.components import connected_components
from lakeledger.llm.pairs import cell_links

SEED = 42  # of the shingle hash; a parameter of the query's contract
BITS_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text: majority of the bits of the XXH64
    of its word shingles, repeats included.  0 for a text without words."""
    import xxhash

    # bytes.lower maps A-Z alone; bytes.split() cuts at 0x20 and 0x09-0x0D
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    start = (end - size)[:max(1, len(words) - shingle + 1)]
    end = end[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[s:e], SEED) for s, e in zip(start.tolist(), end.tolist(), strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), BITS_CHUNK):
        part = h[at:at + BITS_CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, marked: bool = False) -> DataFrame:
    """(doc_id, fp) of a documents table, fp as a signed long; with ``marked``
    also mark, a hash of the text."""
    names = ["doc_id", *(["mark"] if marked else [])]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array(np.array(fp, np.uint64).view(np.int64))], [*names, "fp"])

    rows = documents(docs)
    if marked:
        rows = rows.withColumn("mark", _mark())
    return wide(rows).mapInArrow(each, "".join(f"{n} long, " for n in names) + "fp long")


def popcount_vector(fp: Column) -> Column:
    """The 32 two-bit segment counts of a fingerprint, two bits each."""
    low, next_ = F.lit(0x5555555555555555), F.shiftrightunsigned(fp, 1)
    both, either = fp.bitwiseAND(next_).bitwiseAND(low), fp.bitwiseXOR(next_).bitwiseAND(low)
    return F.shiftleft(both, 1).bitwiseOR(either)


def grid_cells(max_bits: int) -> tuple[list[int], list[tuple[int, int]]]:
    """For each band its mask over the packed vector, and for each cell kind
    (its number, its mask).  One band for every two bits of distance."""
    bands = max_bits // 2 + 1
    if bands > 4:
        raise ValueError("at most 7 bits of distance")
    segs = [32 * i // bands for i in range(bands + 1)]
    masks, cells = [], []
    for lo, hi in zip(segs, segs[1:], strict=False):
        band = sum(3 << (2 * s) for s in range(lo, hi))
        masks.append(band)
        cut = [lo + (hi - lo) * i // 4 for i in range(5)]
        for a, b in zip(cut, cut[1:], strict=False):
            cells.append((len(cells), band & ~sum(3 << (2 * s) for s in range(a, b))))
    return masks, cells


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def close_fingerprints(max_bits: int):
    """Link test for ``cell_links``: the Manhattan distance of the segment
    counts first, then the exact count of differing bits."""
    one = np.uint64(0x5555555555555555)

    def unary(x):
        """Segment counts 0, 1, 2 as 00, 01, 11: their distance is a popcount."""
        counts = x - ((x >> np.uint64(1)) & one)
        return counts | ((counts >> np.uint64(1)) & one)

    def test(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.view(np.uint64), b.view(np.uint64)
        near = np.bitwise_count(unary(a) ^ unary(b)) <= max_bits
        near[near] = np.bitwise_count(a[near] ^ b[near]) <= max_bits
        return near

    return test


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of a documents table.

    Texts link when their fingerprints differ in at most ``max_bits`` bits;
    component_id is the least doc_id reachable over links, the row's own
    included.  Texts without words have fingerprint zero and link like any
    other.  A null text counts as empty; repeated rows are kept and link; a row
    with a null doc_id links like any other and never names a component
    (unless all ids of one are null: then component_id is null).  An empty
    table gives an empty result; other columns are ignored.
    """
    return _grouped(fingerprints(docs, shingle), max_bits).select("doc_id", "fp", "component_id")


def _grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """Add component (one of its fingerprints) and component_id to rows with
    doc_id and fp."""
    fps = stored(fps, "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fp")
    _, cells = grid_cells(max_bits)
    vec = popcount_vector(F.col("fp"))
    rows = distinct.select("fp", F.explode(F.array(*[
        F.struct(F.lit(n).alias("kind"), vec.bitwiseAND(F.lit(_signed(mask))).alias("at"))
        for n, mask in cells])).alias("cell"))
    links = cell_links(rows, "cell", "fp", close_fingerprints(max_bits))
    comp = connected_components(links)
    named = (distinct.join(comp, distinct.fp == comp.node, "left")
             .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "component").select("fp", "component", "component_id")
    return fps.join(by_fp, "fp")


def _mark() -> Column:
    """What tells rows of one id apart: a hash of the text."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The documents that stay, with all columns as they came: of each group
    the one with the least doc_id; of rows of the group that share that id, one
    with the least text.  Rows of one id with texts in different groups are
    rows of their own.  Rows with a null doc_id name no document to keep or
    drop and stay.  Empty texts form one group.  An empty table gives an empty
    result.
    """
    groups = _grouped(fingerprints(docs, shingle, marked=True), max_bits)
    keep = (groups.where("doc_id = component_id")
            .select(F.col("doc_id").alias("_stay"), F.col("mark").alias("_of"), "component").distinct())
    rest = F.struct(*[F.col(c) for c in docs.columns]).alias("_row")
    rows = docs.select(rest, F.col("doc_id").cast("long").alias("_id"), _mark().alias("_mark"),
                       F.coalesce("text", F.lit("")).alias("_text"))
    kept = rows.join(keep, (F.col("_id") == F.col("_stay")) & (F.col("_mark") == F.col("_of")))
    one = kept.groupBy("_id", "component").agg(F.min_by("_row", "_text").alias("_row"))
    return one.select("_row.*").unionByName(docs.where("doc_id is null"))
