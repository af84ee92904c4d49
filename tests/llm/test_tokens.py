import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from llm.helpers import WORDS, awkward_texts, docs_table, empty_docs
from tokenizers import Tokenizer

from lakeledger.llm import packing, token_files, tokens
from lakeledger.session import new_run_dir

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a  b", "a\n\nb \n c", "a\tb  c\x0b", "x" * 300 + " yy", "don't I'll 's 've", "\x00a b", "a\x1cb \x1c c",
       " lead", "trail ", "trail\n", "\nlead", "12 34 567", "Á ́b Σας ΟΔΟΣ", "<|endoftext|> a", "日本語 テスト",
       "a \r\n b\r\nc", "\u0085a \u0085b", "İstanbul ß", "End. Foo, bar; x! don't. A.B. ABC!! É, é. Straße? ok...",
       "THE!! the.\nThe, THE", ".,; a.", "9. 10, x9.", "ǅ. ᾳ, ʰ. K.", " a", "a b c"]


def library(path):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("path,kind", [(BYTE, "byte"), (WORD, "word")])
@pytest.mark.parametrize("generation", [300_000, 40])
def test_encoder_equals_the_library(path, kind, generation, monkeypatch):
    monkeypatch.setattr(tokens, "GENERATION", generation)
    rng = random.Random(4)
    texts = ODD + [t or "" for _, t in awkward_texts()]
    texts += ["".join(rng.choice(" \n\t.,!'aAéÉ9-") for _ in range(rng.randrange(30))) for _ in range(300)]
    texts += [" ".join(rng.choice(WORDS).title() + rng.choice([".", ",", "!?", "", "-x"]) for _ in range(20)) for _ in range(40)]
    enc, lib = tokens.Encoder(path, kind), library(path)
    for at in range(0, len(texts), 25):
        flat, off = enc.encode(texts[at:at + 25], 7)
        for k, t in enumerate(texts[at:at + 25]):
            assert flat[off[k]:off[k + 1]].tolist() == [*lib.encode(t, add_special_tokens=False).ids, 7], t


def test_a_batch_is_looked_up_at_once(monkeypatch):
    enc, calls = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"), "byte"), []
    look_up = tokens._Memo.look_up
    texts = ["", "a b", "so it\u2003goes " + "x" * 200, "", "one, two\n three", "\x1c odd", "b a", ""]
    enc.encode(texts)
    monkeypatch.setattr(tokens._Memo, "look_up", lambda memo, numbers: calls.append(1) or look_up(memo, numbers))
    flat, off = enc.encode(texts, 2)
    assert len(calls) == 1
    want = [enc.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert [flat[s:e].tolist() for s, e in zip(off[:-1], off[1:], strict=True)] == want
    flat, off = enc.encode([], 2)
    assert flat.tolist() == [] and off.tolist() == [0]


def test_token_files_round_trip(spark):
    rows = awkward_texts()
    path = new_run_dir(spark, "tokens") + "/files"
    token_files.write_tokens(docs_table(spark, rows), path, BYTE, "byte", end_id=2)
    got = token_files.with_crc(token_files.read_tokens(spark, path)).collect()
    ids = [[*x.ids, 2] for x in library(BYTE).encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    want = sorted(((-1 if i is None else i), len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                  for (i, _), x in zip(rows, ids, strict=True))
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    # one stream in ascending doc_id order, without gaps
    got.sort(key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in got]
    assert keys == sorted(keys)
    assert [r.start for r in got] == list(np.cumsum([0, *[r.n_tokens for r in got[:-1]]]))


def test_token_file_layout(spark):
    path = new_run_dir(spark, "tokens") + "/files"
    token_files.write_tokens(docs_table(spark, awkward_texts()), path, BYTE, "byte", end_id=2)
    local = path.removeprefix("file:").removeprefix("//")
    import glob
    part = pq.ParquetFile(next(f for f in sorted(glob.glob(local + "/*.parquet")) if pq.ParquetFile(f).metadata.num_rows))
    group = part.metadata.row_group(0)
    chunks = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in chunks["doc_id"].encodings
    assert any("DICTIONARY" in e for e in chunks["ids.list.element"].encodings)
    assert chunks["ids.list.element"].has_offset_index and chunks["doc_id"].has_column_index
    # metadata are read without the ids
    plan = token_files.read_tokens(spark, path).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan


def check_packing(rows, room):
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(seqs)


def test_packed_documents(spark):
    rows = awkward_texts()
    got = packing.pack_documents(docs_table(spark, rows), WORD, "word", end_id=1, room=64).collect()
    ids = [[*x.ids, 1] for x in library(WORD).encode_batch([t or "" for _, t in rows], add_special_tokens=False)]
    want = [(-1 if i is None else i, k // 64, k, len(x[k:k + 64]), zlib.crc32(np.array(x[k:k + 64], "<u4").tobytes()))
            for (i, _), x in zip(rows, ids, strict=True) for k in range(0, len(x), 64)]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    sizes = [w[3] for w in want]
    assert check_packing(got, 64) <= packing.lower_bound({s: sizes.count(s) for s in set(sizes)}, 64) + 3


def brute_bins(sizes, room):
    best = [len(sizes)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(bins)
            return
        for k in sorted(set(bins)):
            if k >= sizes[i]:
                j = bins.index(k)
                go(i + 1, bins[:j] + [k - sizes[i]] + bins[j + 1:])
        go(i + 1, bins + [room - sizes[i]])

    sizes = sorted(sizes, reverse=True)
    go(0, [])
    return best[0]


def test_bin_completion_reaches_the_optimum():
    rng = random.Random(8)
    more = 0
    for _ in range(150):
        room = rng.choice([20, 50])
        sizes = np.array([rng.randrange(1, room + 1) for _ in range(rng.randrange(1, 10))])
        seq, offset = packing.pack_lengths(sizes, room)
        used = len(set(seq.tolist()))
        best = brute_bins(sizes.tolist(), room)
        assert best <= used
        more += used - best
        count = {int(s): int((sizes == s).sum()) for s in set(sizes.tolist())}
        assert packing.lower_bound(count, room) <= best
        assert used <= len(packing.best_fit_decreasing(count, room))
    assert more <= 2


def test_search_beats_best_fit_decreasing():
    sizes = np.array([6, 6, 5, 5, 5, 4, 4, 4, 3, 3, 3, 2, 2, 2, 2, 2, 2] * 3 + [7, 3, 7, 3])
    count = {int(s): int((sizes == s).sum()) for s in set(sizes.tolist())}
    assert len(set(packing.pack_lengths(sizes, 10)[0].tolist())) <= len(packing.best_fit_decreasing(count, 10))


def test_search_fills_with_more_than_four_pieces():
    count = {901: 3000, 696: 2000}  # 3 x 901 + 2 x 696 = 4095
    sizes = np.repeat([901, 696], [3000, 2000])
    seq, offset = packing.pack_lengths(sizes, 4096)
    assert packing.lower_bound(count, 4096) == 1000 < len(packing.best_fit_decreasing(count, 4096))
    assert len(set(seq.tolist())) == 1000
    assert np.bincount(seq, sizes).max() <= 4096 and (offset[1:] != offset[:-1]).any()


def test_search_without_a_budget_is_exact():
    rng = random.Random(9)
    for _ in range(150):
        room = rng.choice([10, 20, 37])
        sizes = [rng.randint(1, room // rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 11))]
        count = {s: sizes.count(s) for s in sizes}
        found = packing.bin_completion(count, room, 1_000_000) or packing.best_fit_decreasing(count, room)
        assert sorted(s for x in found for s in x) == sorted(sizes) and max(map(sum, found)) <= room
        assert len(found) == brute_bins(sizes, room)


def test_empty_tables(spark):
    assert packing.pack_documents(empty_docs(spark), WORD, "word", end_id=1).collect() == []
    path = new_run_dir(spark, "tokens") + "/files"
    token_files.write_tokens(empty_docs(spark), path, BYTE, "byte", end_id=2)
    assert token_files.with_crc(token_files.read_tokens(spark, path)).collect() == []
