"""Periodic runs of words, found by string synchronising sets.

A run is a maximal stretch of words with smallest period q whose length is at
least ``exponent`` x q and ``least``.  Words are compared by 64-bit hashes.

For a scale t, a position is chosen if the least hash among the t + 1 windows
of t words from it on stands at the first or the last of them.  That depends on
the 2t words from the position alone, so equal contexts are chosen alike.
Windows that lie in a run with a period of at most t / 4 count as no window;
every stretch of 3t - 1 words outside such regions has a chosen position among
its first t.  A run with period p, t <= p < 2t, is at least 4p long, so it holds a chosen
position and its next equal context lies exactly p behind it: neighbours with
equal contexts propose all periods of the scale.  Scales are powers of two from
4 on.  Periods 1 to 3 and the highly periodic regions that a scale leaves out
come from the scales before it; 1 to 3 are read off directly.

Proposals are extended in both directions by binary search over running hashes.
All steps are array operations over a batch of texts; a text takes time
n log^2 n.  Only texts of at least 4t words take part in scale t.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeledger.llm.common import documents, size_slices, text_bytes, wide
from lakeledger.llm.wordhash import SPACE, mix, running, span_hash, spans

EXPONENT = 4           # the proof above needs 4 or more
LEAST = 6
DIRECT = 3             # periods read off by comparing neighbours
BATCH_BYTES = 4 << 20

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _direct(h: np.ndarray, left: np.ndarray, p: int, exponent: int) -> np.ndarray:
    """Rows (start, end, p) of the maximal stretches of period p; ``left``
    counts the words from each one to the end of its text."""
    same = np.zeros(len(h) + 1, bool)
    if len(h) > p:
        same[:len(h) - p] = (h[p:] == h[:-p]) & (left[:-p] > p)
    edge = np.flatnonzero(np.diff(np.r_[False, same].astype(np.int8)))
    start, end = edge[::2], edge[1::2] + p
    keep = end - start >= exponent * p
    return np.c_[start[keep], end[keep], np.full(int(keep.sum()), p)]


def _windows(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (count[0] of them), first[1], ..."""
    ends = np.cumsum(count)
    return np.repeat(first - ends + count, count) + np.arange(int(ends[-1]) if len(ends) else 0)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[:-step], x[step:])
        done += step
    return x


def _proposals(sums: np.ndarray, at: np.ndarray, t: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position, period) with t <= period < 2t from neighbours with
    equal contexts of 2t words in the synchronising set of scale t."""
    size = np.diff(at)
    some = np.flatnonzero(size >= EXPONENT * t)
    count = size[some] - t + 1
    place = _windows(at[:-1][some], count)
    name = span_hash(sums, place, place + t)
    # windows inside runs of small period do not count
    periodic = found[(found[:, 2] * 4 <= t) & (found[:, 1] - found[:, 0] >= t)]
    if len(periodic):
        lo, hi = np.searchsorted(place, periodic[:, 0]), np.searchsorted(place, periodic[:, 1] - t, "right")
        mark = np.zeros(len(place) + 1, np.int64)
        np.add.at(mark, lo, 1)
        np.add.at(mark, hi, -1)
        name[np.cumsum(mark[:-1]) > 0] = _NONE
    least = _sliding_min(name, t + 1)
    ends = np.cumsum(count)
    whole = _windows(ends - count, count - t)  # contexts that end in their text
    low = least[whole]
    chosen = whole[(low != _NONE) & ((low == name[whole]) | (low == name[whole + t]))]
    pos = place[chosen]
    text = np.searchsorted(at, pos, "right").astype(np.uint64)
    key = mix(span_hash(sums, pos, pos + 2 * t) + text * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    gap = np.diff(pos[order])
    hit = np.flatnonzero((np.diff(key[order]) == 0) & (gap >= t) & (gap < 2 * t))
    return pos[order][hit], gap[hit]


def _extend(sums: np.ndarray, pos: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Rows (start, end, p): the longest stretch of period p around each
    position, inside its text lo..hi."""
    right, more = np.zeros(len(pos), np.int64), hi - pos - p
    left, less = np.zeros(len(pos), np.int64), pos - lo
    step = 1 << int(max(more.max(), less.max(), 1)).bit_length()
    while step:
        n = right + step
        fits = np.flatnonzero(n <= more)
        a, e, q = pos[fits], n[fits], p[fits]
        fits = fits[span_hash(sums, a, a + e) == span_hash(sums, a + q, a + q + e)]
        right[fits] += step
        n = left + step
        fits = np.flatnonzero(n <= less)
        a, e, q = pos[fits], n[fits], p[fits]
        fits = fits[span_hash(sums, a - e, a) == span_hash(sums, a - e + q, a + q)]
        left[fits] += step
        step >>= 1
    return np.c_[pos - left, pos + p + right, p]


def find_runs(h: np.ndarray, at: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period.  ``h`` has
    the hashes of the words of all texts, ``at`` the n + 1 offsets of the
    texts; starts and ends count from the first word of all."""
    if exponent < EXPONENT:
        raise ValueError(f"runs of an exponent below {EXPONENT} are not found")
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(h))
    found = np.concatenate([_direct(h, left, p, EXPONENT) for p in range(1, DIRECT + 1)]).astype(np.int64)
    sums = running(h)
    t, longest = DIRECT + 1, int(np.diff(at).max(initial=0))
    while EXPONENT * t <= longest:
        pos, p = _proposals(sums, at, t, found)
        if len(pos):
            text = np.searchsorted(at, pos, "right") - 1
            new = np.unique(_extend(sums, pos, p, at[text], at[text + 1]), axis=0)
            found = np.concatenate([found, new[new[:, 1] - new[:, 0] >= EXPONENT * new[:, 2]]])
        t *= 2
    # a multiple of a period has the same stretch: the smallest one stays
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.r_[True, np.any(found[1:, :2] != found[:-1, :2], axis=1)][:len(found)]
    length = found[:, 1] - found[:, 0]
    found = found[new & (length >= least) & (length >= exponent * found[:, 2])]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _batch(ids: pa.Array, texts: pa.Array, exponent: int, least: int) -> pa.RecordBatch:
    raw, off = text_bytes(texts)
    start, end = spans(raw, off, SPACE)
    h = span_hash(running(raw), start, end)
    at = np.searchsorted(start, off)
    runs = find_runs(h, at, exponent, least)
    drop = np.zeros(len(h) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    keep = np.cumsum(drop[:-1]) == 0
    cut = np.searchsorted(runs[:, 0], at)  # of the runs, at the texts
    data, collapsed = raw.tobytes(), []
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        words = data[a:b].split()
        if cut[i + 1] > cut[i]:
            words = [w for w, k in zip(words, keep[at[i]:at[i + 1]].tolist(), strict=True) if k]
        collapsed.append(b" ".join(words))
    first = np.repeat(at[:-1], np.diff(cut))
    each = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first), pa.array(runs[:, 1] - runs[:, 0]),
                                       pa.array(runs[:, 2])], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), each),
         pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row: ``runs`` lists
    (start, length, period) by start and period, counted in words;
    ``collapsed`` is the text with one space between words and each run cut to
    its first period (a word goes if any run has it behind its first period).

    Words are runs of bytes other than ASCII white space.  Null and empty
    texts have no words, no runs and an empty ``collapsed``.  Repeated rows are
    treated alike, a null doc_id stays null, an empty table gives an empty
    result, other columns are ignored.  No shuffle beyond dealing out few splits:
    a text is one unit of work.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in size_slices(batches, 1, BATCH_BYTES):
            yield _batch(b.column(0), b.column(1), exponent, least)

    return wide(documents(docs)).mapInArrow(
        each, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
