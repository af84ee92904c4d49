"""Suffix order and common prefixes of a byte string by external induced sorting.

The suffixes that begin a rise (S*) are sorted first: the substrings between
them get names in their order, and the string of names, at most half as long,
is sorted the same way, recursively.  All other suffixes are induced: in
ascending order each suffix places the one before it if that is of L type, in
descending order if it is of S type.

A priority queue takes the induced tuples (position, common prefix with the tuple
placed before it under the same character) and gives them back in the order
of their character, first in, first out.  As keys never fall during a scan,
it is a queue of key ranges: tuples are appended to their range, held in memory
up to a budget and beyond it on disk, and sorted when the scan gets there.  The
scan works on arrays: it takes all tuples of a range up to the first
character that they themselves place something under, so a step handles
thousands of tuples.

The common prefix of two tuples placed one after the other under a character
is one more than the least common prefix between their sources, which a
running minimum for each character and a sparse table over the step give.
Values are capped at 255.  Those between S* suffixes come from the text.

Memory: the budget, one range of tuples, and the string, which may be a
memory-mapped file, as may the results.
"""

from __future__ import annotations

import tempfile

import numpy as np

from lakeledger.llm.wordhash import running, span_hash

CAP = 255
RANGE = 6000            # tuples a range should hold when characters are many
BUDGET = 64 << 20       # bytes of queued tuples in memory
SMALL = 1 << 21         # strings up to this length are the base of the recursion


class RangeQueue:
    """Tuples (pos, lcp) by range of characters, first in, first out."""

    def __init__(self, ranges: int, budget: int, scratch):
        self.held: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ranges)]
        self.spilled: list[list[tuple[int, int]]] = [[] for _ in range(ranges)]
        self.bytes, self.budget, self.scratch, self.file = 0, budget, scratch, None

    def push(self, where: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> None:
        """Tuples with ascending or descending ``where``."""
        cut = np.flatnonzero(where[1:] != where[:-1]) + 1
        for a, b in zip(np.r_[0, cut].tolist(), np.r_[cut, len(where)].tolist(), strict=True):
            self.held[where[a]].append((pos[a:b], lcp[a:b]))
        self.bytes += 9 * len(pos)
        if self.bytes > self.budget:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.scratch)
        self.file.seek(0, 2)
        for r, parts in enumerate(self.held):
            if parts:
                pos = np.concatenate([p for p, _ in parts]).astype("<i8")
                lcp = np.concatenate([x for _, x in parts]).astype("u1")
                self.spilled[r].append((self.file.tell(), len(pos)))
                self.file.write(pos.tobytes())
                self.file.write(lcp.tobytes())
                self.held[r] = []
        self.bytes = 0

    def pop(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for at, n in self.spilled[r]:
            self.file.seek(at)
            parts.append((np.frombuffer(self.file.read(8 * n), "<i8"), np.frombuffer(self.file.read(n), "u1")))
        parts += self.held[r]
        self.bytes -= 9 * sum(len(p) for p, _ in self.held[r])
        self.held[r], self.spilled[r] = [], []
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint8)
        return np.concatenate([p for p, _ in parts]), np.concatenate([x for _, x in parts])

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class LeastBetween:
    """Minimum of values[a..b], both included, for many pairs at once."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        width = 1
        while 2 * width <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), self.rows[0].dtype)
        for k in np.unique(level).tolist():
            m = level == k
            row = self.rows[k]
            out[m] = np.minimum(row[a[m]], row[b[m] - (1 << k) + 1])
        return out


class Prefixes:
    """The running minima of a scan: for each character, the least common
    prefix since the last tuple placed under it."""

    def __init__(self, chars: int):
        self.since = np.full(chars, CAP, np.uint8)
        self.any = np.zeros(chars, bool)

    def placed(self, lcp: np.ndarray, source: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Common prefixes of tuples placed under ``target`` (grouped, in
        order) by the ``source``-th outputs of a step; ``lcp`` is that of each
        output with the output before it."""
        first = np.r_[True, target[1:] != target[:-1]]
        least = np.empty(len(source), np.uint8)
        upto = np.minimum.accumulate(lcp)
        least[first] = np.minimum(self.since[target[first]], upto[source[first]])
        rest = np.flatnonzero(~first)
        if len(rest):
            least[rest] = LeastBetween(lcp)(source[rest - 1] + 1, source[rest])
        out = np.minimum(least, CAP - 1) + np.uint8(1)
        new = target[first]
        out[first] = np.where(self.any[new], out[first], 0)
        self.any[new] = True
        # what lies between the last tuple of each target and the end of the step
        after = np.r_[np.minimum.accumulate(lcp[::-1])[::-1], np.uint8(CAP)]
        np.minimum(self.since, upto[-1], out=self.since)
        last = np.r_[target[1:] != target[:-1], True]
        self.since[target[last]] = after[source[last] + 1]
        return out

    def passed(self, lcp: np.ndarray) -> None:
        if len(lcp):
            np.minimum(self.since, lcp.min(), out=self.since)


def _types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is of S type; the last is L."""
    n = len(t)
    up = np.zeros(n, bool)
    if n > 1:
        step = t[1:] != t[:-1]
        at = np.where(step, np.arange(n - 1), n)          # the next place where the character changes
        at = np.minimum.accumulate(at[::-1])[::-1]
        live = at < n
        up[:-1][live] = t[at[live] + 1] > t[at[live]]
    return up


def _run_lengths(t: np.ndarray) -> np.ndarray:
    """Length, capped, of the run of equal characters that starts at each place."""
    n = len(t)
    end = np.where(np.r_[t[1:] != t[:-1], True], np.arange(n), n)
    return np.minimum(np.minimum.accumulate(end[::-1])[::-1] - np.arange(n) + 1, CAP).astype(np.uint8)


def _ranges(t: np.ndarray, chars: int) -> tuple[np.ndarray, np.ndarray]:
    """(range of each character, first character of each range and the end)."""
    if chars <= 256:
        return np.arange(chars), np.arange(chars + 1)
    upto = np.cumsum(np.bincount(t, minlength=chars))
    of = (upto - 1) // RANGE
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    return np.searchsorted(first, np.arange(chars), "right") - 1, np.r_[first, chars]


def induce(t: np.ndarray, chars: int, starts: np.ndarray, start_lcp: np.ndarray | None,
           budget: int = BUDGET, scratch: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, common prefix of each with the one before).

    ``starts``: the S* suffixes in order, with their common prefixes; without
    prefixes, in any order that is ascending in the first character, and the
    result is in the order of the substrings up to the next S*.
    """
    n = len(t)
    carry = start_lcp is not None
    of, first = _ranges(t, chars)
    ranges = len(first) - 1
    run = _run_lengths(t) if carry else None
    starts = starts.astype(np.int64)
    s_char = t[starts].astype(np.int64)
    s_at = np.searchsorted(s_char, first)
    none = np.zeros(0, np.uint8)
    l_pos, l_lcp, l_count = [], [], np.zeros(ranges, np.int64)

    def scan(down: bool, queue: RangeQueue, fixed, out_pos: list, out_lcp: list, only_queued: bool) -> None:
        """One scan.  Queue tuples go before the ``fixed`` ones of their
        character (in the order of the scan); ``fixed(r)`` gives those."""
        least = Prefixes(chars)
        if not down:  # the last suffix is placed by the end of the string
            least.any[t[n - 1]] = True
            least.since[t[n - 1]] = 0
        ended = np.full(chars, -1, np.int64)  # the last queue tuple of a character
        for r in (range(ranges - 1, -1, -1) if down else range(ranges)):
            q_pos, q_lcp = queue.pop(r)
            q_char = t[q_pos].astype(np.int64)
            f_pos, f_lcp = fixed(r)
            f_char = t[f_pos].astype(np.int64)
            f_new = np.r_[True, f_char[1:] != f_char[:-1]] if len(f_pos) else np.zeros(0, bool)
            sign = -1 if down else 1
            while len(q_pos) or len(f_pos):
                order = np.argsort(sign * q_char, kind="stable")
                q_pos, q_lcp, q_char = q_pos[order], q_lcp[order], q_char[order]
                # nothing beyond the first character that the range places something under
                stop = None
                for pos, char, queued in ((q_pos, q_char, True), (f_pos, f_char, False)):
                    to = t[np.maximum(pos - 1, 0)].astype(np.int64)
                    if down:
                        hit = (pos > 0) & ((to <= char) if queued else (to < char)) & (to >= first[r])
                        hit = to[hit].max(initial=-1) if hit.any() else None
                        stop = hit if stop is None else stop if hit is None else max(stop, hit)
                    else:
                        hit = (pos > 0) & (to >= char) & (to < first[r + 1])
                        hit = to[hit].min() if hit.any() else None
                        stop = hit if stop is None else stop if hit is None else min(stop, hit)
                if stop is None:
                    nq, nf = len(q_pos), len(f_pos)
                else:
                    nq = int(np.searchsorted(sign * q_char, sign * stop, "right"))
                    nf = int(np.searchsorted(sign * f_char, sign * stop, "left"))
                pos = np.concatenate([q_pos[:nq], f_pos[:nf]])
                char = np.concatenate([q_char[:nq], f_char[:nf]])
                late = np.r_[np.zeros(nq, np.int64), np.ones(nf, np.int64)]
                if nf:
                    order = np.argsort(sign * char * 2 + late, kind="stable")
                    pos, char, late = pos[order], char[order], late[order]
                if carry:
                    lcp = np.concatenate([q_lcp[:nq], f_lcp[:nf]])
                    if nf:
                        if nq:
                            ends = np.flatnonzero(np.r_[q_char[1:nq] != q_char[:nq - 1], True])
                            ended[q_char[ends]] = q_pos[ends]
                        lead = np.flatnonzero(f_new[:nf])
                        mate = ended[f_char[lead]]
                        lcp[nq + lead] = np.where(mate >= 0, np.minimum(run[np.maximum(mate, 0)], run[f_pos[lead]]), 0)
                        lcp = lcp[order]
                    elif nq:
                        ends = np.flatnonzero(np.r_[q_char[1:nq] != q_char[:nq - 1], True])
                        ended[q_char[ends]] = q_pos[ends]
                to = t[np.maximum(pos - 1, 0)].astype(np.int64)
                if down:
                    go = (pos > 0) & ((to < char) | ((to == char) & (late == 0)))
                else:
                    go = (pos > 0) & (to >= char)
                source = np.flatnonzero(go)
                if len(source):
                    target = to[source]
                    order = np.argsort(sign * target, kind="stable")
                    source, target = source[order], target[order]
                    new = least.placed(lcp, source, target) if carry else np.zeros(len(source), np.uint8)
                    place = pos[source] - 1
                    here = int(np.searchsorted(sign * of[target], sign * r, "right"))
                    q_pos, q_lcp, q_char = (np.concatenate([a[nq:], b[:here]]) for a, b in (
                        (q_pos, place), (q_lcp, new), (q_char, target)))
                    if here < len(place):
                        queue.push(of[target[here:]], place[here:], new[here:])
                else:
                    if carry:
                        least.passed(lcp)
                    q_pos, q_lcp, q_char = q_pos[nq:], q_lcp[nq:], q_char[nq:]
                f_pos, f_lcp, f_char, f_new = f_pos[nf:], f_lcp[nf:], f_char[nf:], f_new[nf:]
                if only_queued:
                    mine = late == 0
                    out_pos.append(pos[mine])
                    if carry:
                        out_lcp.append(lcp[mine])
                    l_count[r] += int(mine.sum())
                else:
                    out_pos.append(pos)
                    if carry:
                        out_lcp.append(lcp)

    up = RangeQueue(ranges, budget, scratch)
    up.push(np.array([of[t[n - 1]]]), np.array([n - 1], np.int64), np.zeros(1, np.uint8))
    scan(False, up, lambda r: (starts[s_at[r]:s_at[r + 1]], start_lcp[s_at[r]:s_at[r + 1]] if carry else none),
         l_pos, l_lcp, True)
    up.close()
    large = np.concatenate(l_pos)
    l_end = np.cumsum(l_count)
    # going down, a tuple's common prefix is with the next one up
    large_lcp = np.r_[np.concatenate(l_lcp)[1:], np.uint8(0)] if carry else none
    down = RangeQueue(ranges, budget, scratch)

    def falling(r: int):
        s = slice(int(l_end[r] - l_count[r]), int(l_end[r]))
        return large[s][::-1], large_lcp[s][::-1] if carry else none

    s_pos: list[np.ndarray] = []
    s_lcp: list[np.ndarray] = []
    scan(True, down, falling, s_pos, s_lcp, False)
    down.close()
    order = np.concatenate(s_pos)[::-1]
    if not carry:
        return order, none
    return order, np.r_[np.uint8(0), np.concatenate(s_lcp)[::-1][:-1]]


def common_prefix(sums: np.ndarray, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Capped common prefixes of the suffixes a and b, by halving over the
    running hashes of the text."""
    low = np.zeros(len(a), np.int64)
    most = np.minimum(CAP, n - np.maximum(a, b))
    for step in (128, 64, 32, 16, 8, 4, 2, 1):
        size = low + step
        ok = size <= most
        at, bt, st = a[ok], b[ok], size[ok]
        same = span_hash(sums, at, at + st) == span_hash(sums, bt, bt + st)
        low[np.flatnonzero(ok)[same]] += step
    return low.astype(np.uint8)


def _sorted_starts(t: np.ndarray, chars: int, starts: np.ndarray, budget: int, scratch: str | None) -> np.ndarray:
    """The S* suffixes in order."""
    if len(starts) < 2:
        return starts
    rough = starts[np.argsort(t[starts], kind="stable")]
    order, _ = induce(t, chars, rough, None, budget, scratch)
    is_start = np.zeros(len(t), bool)
    is_start[starts] = True
    order = order[is_start[order]]
    # equal substrings get one name: their hashes, with both ends, agree
    sums = running(t)
    end = np.r_[starts[1:] + 1, len(t)]
    text = np.zeros(len(t), np.uint64)
    text[starts] = span_hash(sums, starts, end) ^ (end - starts).astype(np.uint64)
    text[starts[-1]] += np.uint64(1)  # the last one ends with the string and is like no other
    h = text[order]
    name = np.zeros(len(t), np.int64)
    name[order] = np.cumsum(np.r_[0, h[1:] != h[:-1]])
    names = name[starts]
    if int(names.max()) + 1 == len(starts):
        return order
    return starts[suffix_order(names, int(names.max()) + 1, budget, scratch)]


def _direct(t: np.ndarray) -> np.ndarray:
    """The base of the recursion: ranks of ever longer prefixes, doubled; only
    suffixes that still share their rank are sorted again."""
    n, width = len(t), 1
    at = np.arange(n)
    order = np.argsort(t, kind="stable")
    new = np.r_[True, t[order][1:] != t[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    open_ = order[~(new & np.r_[new[1:], True])]
    while len(open_):
        then = np.where(open_ + width < n, rank[np.minimum(open_ + width, n - 1)] + 1, 0)
        key = rank[open_] << 32 | then
        order = np.argsort(key, kind="stable")
        open_, key = open_[order], key[order]
        new = np.r_[True, key[1:] != key[:-1]]
        base = key >> 32
        group = np.maximum.accumulate(np.where(new, at[:len(key)], 0))
        head = np.maximum.accumulate(np.where(np.r_[True, base[1:] != base[:-1]], at[:len(key)], 0))
        rank[open_] = base + group - head
        open_ = open_[~(new & np.r_[new[1:], True])]
        width *= 2
    order = np.empty(n, np.int64)
    order[rank] = at
    return order


def suffix_order(t: np.ndarray, chars: int, budget: int = BUDGET, scratch: str | None = None) -> np.ndarray:
    """The suffixes of a string of numbers below ``chars`` in order."""
    if len(t) <= SMALL:
        return _direct(t)
    up = _types(t)
    starts = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    return induce(t, chars, _sorted_starts(t, chars, starts, budget, scratch), None, budget, scratch)[0]


def suffixes(text: np.ndarray, budget: int = BUDGET, scratch: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, capped common prefixes) of a string of bytes."""
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    up = _types(text)
    starts = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    starts = _sorted_starts(text, 256, starts, budget, scratch)
    lcp = np.zeros(len(starts), np.uint8)
    if len(starts) > 1:
        lcp[1:] = common_prefix(running(text), len(text), starts[:-1], starts[1:])
    return induce(text, 256, starts, lcp, budget, scratch)
