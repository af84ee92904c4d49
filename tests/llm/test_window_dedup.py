import hashlib
import random

from llm.helpers import awkward_texts, docs_table, empty_docs

from lakeledger.llm import queries, window_dedup


def brute(rows, window):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, words in docs:
        if i is not None:
            for k in range(len(words) - window + 1):
                key = tuple(words[k:k + window])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, words in docs:
        gone = set()
        for k in range(len(words) - window + 1 if i is not None else 0):
            if least[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    rows = []
    for r in df.collect():
        spans = [tuple(s) for s in r.removed]
        assert all(a < b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
        rows.append((r.doc_id, r.n_words, sum(b - a for a, b in spans), hashlib.sha256(r.kept_text.encode()).hexdigest()))
    return sorted(rows, key=repr)


def passages(seed=4, n=60):
    """Texts that share passages around the window's length, copies, ids in
    another order than the rows, and repeated ids with other texts."""
    rng = random.Random(seed)
    shared = [[f"p{j}w{k}" for k in range(rng.choice([7, 8, 9, 30]))] for j in range(6)]
    rows = []
    for i in range(n):
        words = [f"{rng.randrange(5)}" for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(4)):
            words += rng.choice(shared) + [f"x{rng.randrange(9)}" for _ in range(rng.randrange(6))]
        rows.append((n - i if i % 9 else 5, " \t".join(words)))
    return rows


def test_equals_brute_force_in_batches_of_any_size(spark):
    rows = passages() + awkward_texts()
    for window, size in ((8, 1 << 9), (8, 1 << 20), (1, 1 << 9), (3, 1 << 12)):
        got = window_dedup.drop_repeated_windows(docs_table(spark, rows), window, size, size * 2)
        assert result(got) == brute(rows, window)


def test_query_equals_brute_force(spark, tmp_path):
    rows = awkward_texts(n=20)
    long = " ".join(f"word{i}" for i in range(120))
    rows += [(900, long), (901, "before " + long + " behind"), (902, long[:300] + " " + long[300:]), (-3, "x " + long[200:])]
    docs_table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op12_substring_dedup"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 50)


def test_empty_table(spark):
    assert window_dedup.drop_repeated_windows(empty_docs(spark)).collect() == []


def test_hot_window_is_sent_once_a_batch(spark):
    """300 copies of a text: each batch sends its distinct windows alone."""
    import numpy as np
    import pyarrow as pa
    text = " ".join(f"w{i}" for i in range(80))
    table = pa.table({"doc_id": pa.array(range(300), pa.int64()), "text": [text] * 300})
    w = window_dedup._Windows(table, 50)
    assert len(w.key) == 31 and sum(window_dedup._sent(0, w, 3)["n"].to_pylist()) == 31
    assert np.all(w.later.reshape(31, 300)[:, 1:]) and not w.later.reshape(31, 300)[:, 0].any()
