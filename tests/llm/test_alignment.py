import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import awkward_texts, docs_table, empty_docs

from lakeledger.llm import aligner, alignment, queries

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def brute_groups():
    """Groups of a whole text by the two libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def run(text):
        if not text:
            return []
        one = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
               for i in b.encode(text)]
        want = (" " + text).encode()
        if b"".join(x for _, x in one) != want or b"".join(x for _, x in two) != want:
            return []
        ends = []
        for side in (one, two):
            at, end = 0, {}
            for k, (_, x) in enumerate(side):
                at += len(x)
                end[at] = k + 1
            ends.append(end)
        groups, i, j = [], 0, 0
        for at in sorted(set(ends[0]) & set(ends[1])):
            groups.append(([x for x, _ in one[i:ends[0][at]]], [x for x, _ in two[j:ends[1][at]]]))
            i, j = ends[0][at], ends[1][at]
        return groups
    return run


def brute(rows, groups_of):
    docs = [(i, groups_of(t)) for i, t in rows]
    links = [[(a, b) for x, y in g for a in x for b in y] for _, g in docs]
    count = Counter(p for own in links for p in set(own))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for (i, g), own in zip(docs, links, strict=True):
        form = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(own),
                    sum(count[p] == most[p[0]] for p in own), sum(count[p] for p in own),
                    hashlib.sha256(form.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr), count, Counter(p for own in links for p in own)


ODD = ["<|endoftext|> <s> </s> <unk> <0x0A>", "under▁score", "a ▁ b", " lead", "trail ", "two  spaces\n\nlines\n", "tab\there",
       "\r\nx", "\x00zero", "日本語 テキスト 𝒳 👍🏽", "½ ﬁ é", " nbsp", "a\nb\nc d", "x" * 70 + " y", "\n", " ", "don't I'll 'S it's"]


def test_query_equals_brute_force(spark, tmp_path, brute_groups):
    rows = awkward_texts(n=40) + [(700 + i, t) for i, t in enumerate(ODD)]
    docs_table(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_cross_tokenizer_alignment"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, brute_groups)[0]


def test_index_counts_documents_and_links(spark, brute_groups, monkeypatch):
    """Several parts a block and planes of multiplicity, merged."""
    monkeypatch.setattr(alignment, "PART_BYTES", 500)
    rows = awkward_texts(n=40)
    found = alignment.align(docs_table(spark, rows, parts=1), *PATHS)
    _, docs, links = brute(rows, brute_groups)
    assert {(r.pair >> 32, r.pair & 0xFFFFFFFF): (r.n_docs, r.n_links) for r in found.pairs.collect()} == {
        p: (n, links[p]) for p, n in docs.items()}
    assert found.index.groupBy("pair", "block", "plane").count().where("count > 1").count() == 0
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", 0)
    assert sorted(map(tuple, alignment.score(found).collect()), key=repr) == brute(rows, brute_groups)[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t.,▁'1日  "), max_size=30), max_size=8))
def test_words_align_as_whole_texts(brute_groups, texts):
    counts, sha, doc, pairs = aligner.aligner(*PATHS).documents(texts)
    for i, t in enumerate(texts):
        g = brute_groups(t)
        form = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        assert sha[i] == (hashlib.sha256(form.encode()).hexdigest() if g else "")
        assert pairs[doc == i].tolist() == [a << 32 | b for x, y in g for a in x for b in y]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.one_of(st.integers(0, 40), st.integers(0, 65535)), min_size=1, max_size=60), min_size=1, max_size=6))
def test_bitmaps_round_trip(sets):
    size = np.array([len(s) for s in sets])
    pos = np.array([x for s in sets for x in sorted(s)])
    row, back = alignment.from_bitmaps(alignment.to_bitmaps(size, pos))
    assert sorted(zip(row.tolist(), back.tolist())) == [(i, x) for i, s in enumerate(sets) for x in sorted(s)]


def test_slices_hold_a_bounded_number_of_numbers(monkeypatch):
    # bitmaps of frequent pairs hold up to 8 numbers a byte: bytes or rows do not bound what they unpack to
    monkeypatch.setattr(alignment, "NUMBERS", 5000)
    sizes = np.array([4000, 1, 3, 9000, 10, 4000, 4000, 2])
    bits = alignment.to_bitmaps(sizes, np.concatenate([np.arange(n) * (1 if n > 100 else 500) for n in sizes]))
    most = alignment.most_numbers(bits)
    assert (most >= sizes).all() and (most < sizes + 16).all()
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(sizes))), bits], ["i", "bits"])
    parts = list(alignment._bounded(batch, most))
    assert [i for b in parts for i in b.column(0).to_pylist()] == list(range(len(sizes)))
    assert all(b.num_rows == 1 or len(alignment.from_bitmaps(b.column(1))[0]) <= 5000 for b in parts)
    assert len(parts) == 4
    lists = pa.ListArray.from_arrays(pa.array([0, 2, 2, 5, 8], pa.int32()), bits)
    assert alignment.part_numbers(lists).tolist() == [most[:2].sum(), 0, most[2:5].sum(), most[5:].sum()]
    assert alignment.part_numbers(lists.slice(2)).tolist() == [most[2:5].sum(), most[5:].sum()]
    assert alignment.most_numbers(bits[:0]).tolist() == [] and not list(alignment._bounded(batch[:0], most[:0]))


def test_empty_table(spark):
    assert alignment.score(alignment.align(empty_docs(spark), *PATHS)).collect() == []
