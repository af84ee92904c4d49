import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward_texts, docs_table, empty_docs

from lakeledger.llm import components, simhash


def brute_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, bits):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for lab, (i, _) in zip(label, rows, strict=True):
        if i is not None:
            least[lab] = min(least.get(lab, i), i)
    return sorted(((i, f, least.get(lab)) for (i, _), f, lab in zip(rows, fps, label, strict=True)), key=repr)


def test_groups_equal_brute_force(spark):
    rows = awkward_texts()
    for bits in (3, 5):
        got = simhash.simhash_groups(docs_table(spark, rows), max_bits=bits).collect()
        got = sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=repr)
        assert got == brute_components(rows, bits)


def test_empty_table(spark):
    assert simhash.simhash_groups(empty_docs(spark)).collect() == []
    assert simhash.simhash_dedup(empty_docs(spark)).collect() == []


def test_dedup_keeps_one_of_each_group_with_its_columns(spark):
    rows = awkward_texts()
    docs = docs_table(spark, rows)
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = {c for _, _, c in brute_components(rows, 3) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ids.count(None) == 2  # rows without an id stay


def test_dedup_keeps_rows_of_one_id_by_group(spark):
    """Two groups that are both named by id 5, and a near copy under a larger id."""
    one, two = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    docs = docs_table(spark, [(5, two), (5, one), (5, one), (7, two), (9, one), (8, " ".join(f"c{i}" for i in range(80)))])
    kept = simhash.simhash_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text[:2]) for r in kept.collect()) == [(5, "a0"), (5, "b0"), (8, "c0")]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=7))
def test_linked_fingerprints_share_a_cell(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    _, cells = simhash.grid_cells(max(3, len(flips)))
    low = 0x5555555555555555
    vector = [((x >> 1) & x & low) << 1 | ((x >> 1) ^ x) & low for x in (fp, other)]
    assert any(vector[0] & mask == vector[1] & mask for _, mask in cells)
    test = simhash.close_fingerprints(3)
    near = test(np.array([fp], np.uint64).view(np.int64), np.array([other], np.uint64).view(np.int64))[0]
    assert near == (len(flips) <= 3)


def test_large_cells_are_dealt_in_blocks(spark, monkeypatch):
    """Thousands of near copies in one cell, with a small block."""
    from lakeledger.llm import pairs
    rng = random.Random(1)
    center = rng.getrandbits(64)
    fps = {center ^ (1 << rng.randrange(64)) for _ in range(500)} | {rng.getrandbits(64) for _ in range(200)}
    rows = spark.createDataFrame([(7, x - (1 << 64) if x >> 63 else x) for x in fps], "cell long, fp long")
    dealt = pairs.block_pairs(rows, "cell", "fp", block=16)
    assert dealt.groupBy("lo", "hi").count().agg({"count": "max"}).first()[0] < 120
    monkeypatch.setattr(pairs.block_pairs, "__defaults__", (16,))
    links = pairs.cell_links(rows, "cell", "fp", simhash.close_fingerprints(3))
    groups = components.connected_components(links).groupBy("component").count().orderBy("count").collect()
    assert groups[-1]["count"] == len({x for x in fps if (x ^ center).bit_count() <= 1})
