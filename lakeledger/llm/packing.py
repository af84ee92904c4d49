"""Best-fit packing of token pieces into sequences by bin completion.

Pieces are dealt at random into shards of about ``SHARD_PIECES`` and each
shard is packed by one task, so no task holds more than a shard and a shard
wastes at most about one sequence more than the whole would (one in some
thousand).  In a shard:

* best fit decreasing gives the first incumbent; if it meets the lower bound
  (the tokens, and the pieces over half a sequence) it is optimal;
* else branch and bound by bin completion: the largest piece opens a
  sequence, and the fillings of the room around it, of any number of pieces,
  are enumerated depth first over the distinct lengths, fullest first.  Bit
  sets of the sums that the shorter lengths reach keep the enumeration from
  dead ends.  A filling is left out if it is dominated (a piece outside can
  take the place of some of its pieces and fills as much or more), and a
  branch ends when its waste exceeds what a solution with one sequence less
  may waste.  A better solution becomes the incumbent.  The search has a
  budget of nodes (fillings looked at), several times what a way down to a
  solution takes; what it proves or finds by then counts, so the result is
  never worse than best fit decreasing.

Lengths are small integers, so a shard is a count for each length, and
"largest piece that fits" is a bit scan of one Python integer.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import documents, drop_caches, slices, stored, wide
from lakeledger.llm.token_files import crc_of
from lakeledger.llm.tokens import encoder

SHARD_PIECES = 8192
NODES_PER_PIECE = 4
BATCH = 256


def pieces(docs: DataFrame, tokenizer: str, kind: str, end_id: int, room: int, keep_memo: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the
    end id, cut every ``room`` ids.  ``keep_memo``: a worker keeps the words that
    it has encoded for its next task; else it gives the memory back."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, kind)
        for b in slices(batches, BATCH):
            flat, off = enc.encode(b.column(1).to_pylist(), end_id)
            size = np.diff(off)
            n = -(-size // room)
            row = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * room
            length = np.minimum(room, size[row] - start)
            at = off[:-1][row] + start
            crc = [crc_of(flat[s:s + k]) for s, k in zip(at.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                 pa.array(length), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
        if not keep_memo:
            del enc
            drop_caches()

    return wide(documents(docs)).mapInArrow(
        each, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(count: dict[int, int], room: int) -> list[tuple[int, ...]]:
    """Sequences (tuples of lengths): each piece, the longest first, goes
    where it leaves the least room."""
    open_: dict[int, list[list[int]]] = {}
    rooms, out = 0, []  # rooms: bit r is set if a sequence has room r
    for size in sorted(count, reverse=True):
        for _ in range(count[size]):
            fits = rooms >> size
            if fits:
                r = size + (fits & -fits).bit_length() - 1
                seq = open_[r].pop()
                if not open_[r]:
                    rooms &= ~(1 << r)
            else:
                r, seq = room, []
                out.append(seq)
            seq.append(size)
            r -= size
            if r:
                open_.setdefault(r, []).append(seq)
                rooms |= 1 << r
    return [tuple(x) for x in out]


def lower_bound(count: dict[int, int], room: int) -> int:
    """Martello and Toth's L2: for each k, pieces over room - k are alone, and
    the rest of at least k fills what the other halves leave."""
    sizes = np.array([s for s in sorted(count, reverse=True) for _ in range(count[s])], np.int64)
    best = -(-int(sizes.sum()) // room)
    total = np.r_[0, np.cumsum(sizes)]
    at_least = lambda x: int(np.searchsorted(-sizes, -x, "right"))  # pieces of x or more
    half = int(np.searchsorted(-sizes, -(room / 2), "left"))        # pieces over half
    for k in {s for s in count if 2 * s <= room} | {0}:
        alone = at_least(room - k + 1)
        low = at_least(k) if k else len(sizes)
        left = (half - alone) * room - int(total[half] - total[alone])
        rest = int(total[low] - total[half]) - left
        best = max(best, half + max(0, -(-rest // room)))
    return best


def _reachable(left: dict[int, int], room: int) -> tuple[list[int], list[int]]:
    """(sizes, reach): the sizes that are left and fit, ascending; bit x of
    reach[i] is set if pieces of the first i sizes can add up to x."""
    sizes = [s for s, n in left.items() if n and s <= room]
    whole, r = (1 << (room + 1)) - 1, 1
    reach = [r]
    for s in sizes:
        if r != whole:
            n, k = min(left[s], room // s), 1
            while n:  # 1, 2, 4, ... copies at a time: any number up to n
                m = min(k, n)
                r |= r << (m * s)
                n, k = n - m, 2 * k
            r &= whole
        reach.append(r)
    return sizes, reach


def _complete(left, sizes, reach, i: int, total: int) -> list[tuple[int, int]]:
    """The first filling (index, copies) of exactly ``total``, reachable with
    the first i sizes: as many of the largest as can be."""
    out = []
    while total:
        i = min(i, bisect_right(sizes, total)) - 1
        for k in range(min(left[sizes[i]], total // sizes[i]), -1, -1):
            rest = total - k * sizes[i]
            if reach[i] >> rest & 1:
                break
        if k:
            out.append((i, k))
        total = rest
    return out


def _next(left, sizes, reach, fill: list[tuple[int, int]]) -> list[tuple[int, int]] | None:
    """The filling of the same total after ``fill``, or None."""
    rest = 0
    for at in range(len(fill) - 1, -1, -1):
        i, had = fill[at]
        rest += had * sizes[i]
        for k in range(had - 1, -1, -1):
            if reach[i] >> (rest - k * sizes[i]) & 1:
                return [*fill[:at], *([(i, k)] if k else []),
                        *_complete(left, sizes, reach, i, rest - k * sizes[i])]
    return None


def _dominated(left, sizes, fill: list[tuple[int, int]], waste: int) -> bool:
    """Martello and Toth's test: one piece that is left over can take the place
    of some of the filling's (or of none) and fills as much or more."""
    one = many = outside = 0  # sums of one piece of the filling, and of several
    used = dict(fill)
    for i, s in enumerate(sizes):
        n = used.get(i, 0)
        if left[s] > n:
            outside |= 1 << s
        for _ in range(n):
            many |= (many | one) << s
            one |= 1 << s
    more, width = 1 | one | many, 1
    spread = many
    if waste:
        while width < waste:  # moved by 0 .. waste - 1
            step = min(width, waste - width)
            more |= more << step
            width += step
        spread |= more << 1
    return bool(spread & outside)


def bin_completion(count: dict[int, int], room: int, nodes: int) -> list[tuple[int, ...]] | None:
    """A solution with less sequences than best fit decreasing, or None."""
    incumbent = best_fit_decreasing(count, room)
    bound = lower_bound(count, room)
    total = sum(s * n for s, n in count.items())
    best = None
    left = {s: count[s] for s in sorted(count)}
    present = sum(1 << s for s in count)
    path: list[tuple[int, list[tuple[int, int]], tuple[int, ...]]] = []  # total, filling, sequence
    waste, limit = 0, len(incumbent)

    def advance(top: int, before: int | None, fill: list[tuple[int, int]]) -> tuple | None:
        """The next undominated filling around ``top`` whose waste a solution
        with less sequences can bear, as an entry of the path."""
        nonlocal nodes
        free = room - top
        slack = (limit - 1) * room - total - waste
        if slack < 0:
            return None
        sizes, reach = _reachable(left, free)
        now = free if before is None else before
        fill = None if before is None else _next(left, sizes, reach, fill)
        while nodes > 0:
            nodes -= 1
            if fill is None:  # the next total below
                below = reach[-1] & ((1 << (now + (before is None))) - 1)
                now, before = below.bit_length() - 1, now
                if now < 0 or free - now > slack:
                    return None
                fill = _complete(left, sizes, reach, len(sizes), now)
            if not _dominated(left, sizes, fill, free - now):
                return now, fill, (top, *(sizes[i] for i, k in fill for _ in range(k)))
            fill = _next(left, sizes, reach, fill)
        return None

    while limit > bound and nodes > 0:
        before, fill = None, []
        if not present:
            best = [seq for _, _, seq in path]
            limit = len(best)
        # the next branch: around the largest piece, or back to an earlier one
        while limit > bound and nodes > 0:
            entry = None
            if present:
                top = present.bit_length() - 1
                left[top] -= 1
                entry = advance(top, before, fill)
                left[top] += 1
            if entry:
                for s in entry[2]:
                    left[s] -= 1
                    if not left[s]:
                        present &= ~(1 << s)
                waste += room - sum(entry[2])
                path.append(entry)
                break
            if not path:
                return best
            before, fill, seq = path.pop()
            for s in seq:
                left[s] += 1
                present |= 1 << s
            waste -= room - sum(seq)
    return best


def pack_lengths(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) for each piece, in as few sequences as the
    search finds."""
    sizes, counts = np.unique(lengths, return_counts=True)
    count = {int(s): int(n) for s, n in zip(sizes, counts, strict=True)}
    seqs = bin_completion(count, room, NODES_PER_PIECE * len(lengths)) or best_fit_decreasing(count, room)
    order = np.argsort(lengths, kind="stable")
    at = {int(s): i for s, i in zip(sizes, np.cumsum(counts) - counts, strict=True)}
    seq_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for n, seq in enumerate(seqs):
        place = 0
        for s in seq:
            i = order[at[s]]
            at[s] += 1
            seq_of[i], offset[i] = n, place
            place += s
    return seq_of, offset


def pack(cut: DataFrame, room: int) -> DataFrame:
    """Add sequence_id and offset to a table of pieces (column length, 1 to
    ``room``).  Ties and repeated rows are separate pieces."""
    cut = stored(cut.withColumn("_u", F.rand(17)), "pieces")
    shards = max(1, -(-cut.count() // SHARD_PIECES))
    shard = F.least(F.floor(F.col("_u") * shards), F.lit(shards - 1)).cast("int")

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_u", ignore_index=True)
        seq, offset = pack_lengths(pdf["length"].to_numpy(), room)
        pdf["sequence_id"] = pdf["_shard"].to_numpy(np.int64) * (1 << 32) + seq
        pdf["offset"] = offset
        return pdf.drop(columns=["_u", "_shard"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields if f.name != "_u")
    return (cut.withColumn("_shard", shard).groupBy("_shard")
            .applyInPandas(each, f"{fields}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, tokenizer: str, kind: str, end_id: int, room: int = 4096,
                   keep_memo: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Every document, null or empty text included, has at least the end id and
    so at least one piece.  A null doc_id stays null; repeated rows are packed
    each by itself; an empty table gives an empty result; other columns are
    ignored.  Only documents of over ``room`` ids are cut.
    """
    return pack(pieces(docs, tokenizer, kind, end_id, room, keep_memo), room)
