import collections
import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward_texts, docs_table, empty_docs

from lakeledger.llm import induced, suffix_dedup


def brute_order(b):
    order = sorted(range(len(b)), key=lambda i: b[i:])

    def prefix(x, y):
        k = 0
        while max(x, y) + k < len(b) and b[x + k] == b[y + k] and k < 255:
            k += 1
        return k
    return order, [0] + [prefix(order[i - 1], order[i]) for i in range(1, len(order))]


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=8), st.lists(st.integers(97, 100), max_size=100), st.integers(1, 6), st.integers(1, 40),
       st.sampled_from([100, 1 << 20]))
def test_suffix_order_and_prefixes(head, body, times, width, budget):
    """Also with every recursion taken, narrow ranges and a queue on disk."""
    b = bytes(body) + head * times
    small, ranges = induced.SMALL, induced.RANGE
    induced.SMALL, induced.RANGE = 3, width
    try:
        order, lcp = induced.suffixes(np.frombuffer(b, np.uint8), budget=budget)
    finally:
        induced.SMALL, induced.RANGE = small, ranges
    want = brute_order(b)
    assert (order.tolist(), lcp.tolist() if len(b) else [0]) == want


def brute(texts, length):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(t) else 0
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def planted():
    rows = awkward_texts()
    passage = "this very passage stands in many documents, between texts that differ from each other. " * 3
    rows += [(500 + i, f"{'q' * (i % 9)} begin {i * 7919} {passage} {i * 104729} end {'z' * (i % 5)}") for i in range(40)]
    rows += [(600, "abc" * 400), (601, "abcd " + "abc" * 100 + " tail"), (602, "u" * 199), (603, "v" * 200),
             (604, "w" * 201), (605, "w" * 200)]
    return rows


def test_removed_bytes_equal_brute_force(spark):
    rows = planted()
    want = brute([(t or "").encode() for _, t in rows], 200)
    docs = docs_table(spark, rows)
    plain = suffix_dedup.repeated_spans
    for hot in (4096, 3):  # the second cuts seeds again until they are windows
        suffix_dedup.repeated_spans = lambda d, length, h=hot: plain(d, length, hot=h)
        try:
            got = suffix_dedup.deduplicate(docs, ["doc_id"]).collect()
        finally:
            suffix_dedup.repeated_spans = plain
        assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=repr) == sorted(
            ((i, *w) for (i, _), w in zip(rows, want, strict=True)), key=repr)


def test_kept_text_and_other_columns(spark):
    rows = [(1, "é" * 120 + "ab" * 60), (2, "é" * 120 + "cd" * 60), (3, None)]
    docs = docs_table(spark, rows)
    got = {r.doc_id: r for r in suffix_dedup.deduplicate(docs, docs.columns, with_text=True).collect()}
    assert got[1].kept_text == "ab" * 60 and got[3].kept_text == "" and got[2].score == 1.5


def test_empty_table(spark):
    assert suffix_dedup.deduplicate(empty_docs(spark), ["doc_id"]).collect() == []


def test_strings_beyond_the_prefix_cap_are_refused(spark):
    docs = docs_table(spark, [(1, "x"), (2, "y")])
    with pytest.raises(ValueError, match="up to 255 bytes"):
        suffix_dedup.repeated_spans(docs, length=256)
    assert suffix_dedup.repeated_spans(docs, length=255).collect() == []


class Rows:
    """Takes the place of a frame whose rows are sorted already."""

    def repartition(self, *by):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, each, schema):
        return each


def test_memory_of_the_region_sort():
    """A task's memory does not follow its input, and two tasks fit into an
    executor of 3 GB beside its heap."""
    rng = np.random.default_rng(1)
    raw = rng.integers(97, 123, 400_000).astype(np.uint8).tobytes()
    kinds = ["seed", "shape", "row", "place", "n", "bytes"]

    def batches():
        for first in range(0, 4000, 250):  # pairs of regions, one seven bytes further on: 2.6 MB
            at = rng.integers(0, len(raw) - 400, 250)
            parts = [raw[a + d:a + d + 330] for a in at.tolist() for d in (0, 7)]
            row = np.arange(2 * first, 2 * first + len(parts))
            yield pa.RecordBatch.from_arrays(
                [pa.array(row // 2), pa.array(row), pa.array(row), pa.array(row << 16),
                 pa.array(np.ones(len(row), np.int64)), pa.array(parts, pa.binary())], kinds)

    each = suffix_dedup._sort_regions(Rows(), 200)
    tracemalloc.start()
    try:
        found = sum(b.num_rows for b in each(batches()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found >= 8000
    assert peak < 150 << 20
