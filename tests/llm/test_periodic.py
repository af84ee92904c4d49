import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward_texts, docs_table, empty_docs

from lakeledger.llm import periodic, queries


def brute_runs(words, least=6):
    """All runs by trying every period at every place."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 4 * q):
                out.setdefault((i, j + q), q)  # the smallest period first
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def brute_row(doc_id, text):
    words = planted(doc_id, [w.decode() for w in (text or "").encode().split()])
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (
        "".join(f"{s},{n},{q}\n" for s, n, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = awkward_texts()
    for i in range(200, 320):  # sequences with periods of many sizes and few letters
        part = [rng.choice("abcdef") for _ in range(rng.randrange(1, 40))]
        words = [rng.choice("abc") for _ in range(rng.randrange(30))] + part * rng.randrange(1, 9)
        rows.append((i, " ".join(words + part[:rng.randrange(len(part))] + [rng.choice("xyz")] * rng.randrange(12))))
    docs_table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute_row(*r) for r in rows), key=repr)


def letters(words):
    return (np.frombuffer("".join(words).encode(), np.uint8).astype(np.uint64) + np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=23), st.integers(1, 12)), min_size=1, max_size=6))
def test_runs_of_any_shape(parts):
    """Repeats of random words over two letters, side by side in one batch."""
    texts = ["".join(w * n for w, n in parts), "", "".join(w * n for w, n in parts[::-1]), "a"]
    at = np.cumsum([0, *map(len, texts)])
    got = periodic.find_runs(letters("".join(texts)), at).tolist()
    assert got == [[s + a, s + a + n, q] for t, a in zip(texts, at) for s, n, q in brute_runs(t)]


def test_long_periods():
    rng = np.random.default_rng(2)
    for p in (4, 5, 63, 64, 65, 1000, 2047):
        one = rng.integers(0, 1 << 60, p).astype(np.uint64)
        h = np.r_[rng.integers(0, 1 << 60, 77).astype(np.uint64), np.tile(one, 4), rng.integers(0, 1 << 60, 9).astype(np.uint64)]
        assert periodic.find_runs(h, np.array([0, len(h)])).tolist() == [[77, 77 + 4 * p, p]]
        assert len(periodic.find_runs(h[:77 + 4 * p - 1], np.array([0, 77 + 4 * p - 1]))) == 0


def test_nested_periods():
    """A run of runs: 'aaaaaaab' five times, and that with a tail four times."""
    inner = "aaaaaaab" * 5
    words = (inner + "cdefg") * 4
    got = periodic.find_runs(letters(words), np.array([0, len(words)])).tolist()
    assert got == [[s, s + n, q] for s, n, q in brute_runs(words)]
    assert {q for _, _, q in got} == {1, 8, 45}


def test_empty_table(spark):
    assert periodic.periodic_runs(empty_docs(spark)).collect() == []
