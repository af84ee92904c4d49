"""The pipeline stage by stage against brute force, and as a query."""

import collections
import zlib

import corpus_pipeline as P
import numpy as np
import public_tokenizers
from llm.test_simhash import brute_fingerprint
from llm.test_suffix_dedup import brute as brute_removal
from llm.test_tokens import check_packing, library

from lakeledger.llm import mixing, quality_rules
from lakeledger.llm.common import read_table, stored

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    names = [n for n, _ in P.STAGES]
    assert names == ["quality rules", "SimHash near-dedup", "suffix-array dedup", "mixing to target weights",
                     "best-fit packing"]
    stage = dict(P.STAGES)

    kept = stored(stage[names[0]](spark, docs, SF), "t")
    verdicts = {r.doc_id: r.kept for r in quality_rules.quality_rules(docs).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, k in verdicts.items() if k} and kept.columns == docs.columns

    rows = {r.doc_id: r.text for r in kept.collect()}
    ids = sorted(rows)
    fps = [brute_fingerprint(rows[i]) for i in ids]
    group = list(range(len(ids)))
    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3 and group[a] != group[b]:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    single = stored(stage[names[1]](spark, kept, SF), "t")
    assert sorted(r.doc_id for r in single.collect()) == sorted({ids[g] for g in group})
    assert single.columns == docs.columns

    cut = stored(stage[names[2]](spark, single, SF), "t")
    before = {r.doc_id: r.text for r in single.collect()}
    after = {r.doc_id: r for r in cut.collect()}
    want = brute_removal([before[i].encode() for i in sorted(before)], 200)
    assert cut.columns == docs.columns and set(after) == set(before)
    for i, (size, gone, _, _) in zip(sorted(before), want, strict=True):
        assert size - gone - 6 <= len(after[i].text.encode()) <= size - gone
        assert after[i].n_chars == len(after[i].text)

    mixed = stored(stage[names[3]](spark, cut, SF), "t")
    model = mixing.domain_model(cut, read_table(spark, SF, "labels"))
    rates = mixing.mix(cut, model, P.MIX, ["doc_id"], full="clean", times=P.TIMES).collect()
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert mixed.columns == docs.columns and copies == {r.doc_id: r.copies for r in rates if r.copies}

    packed = stage[names[4]](spark, mixed, SF).collect()
    lib = library(public_tokenizers.path("word_bpe_49k.json"))
    expect = collections.Counter()
    for r in mixed.collect():
        x = [*lib.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(x), 4096):
            part = np.array(x[k:k + 4096], "<u4")
            expect[r.doc_id, k // 4096, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expect
    assert check_packing(packed, 4096) <= -(-sum(r.length for r in packed) // 4096) + 1


def test_run_is_the_stages_in_turn(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() > 0 and P.ORACLE_SQL is None


def test_entry_has_all_corpus_queries():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11))


CLASHING = ["n_bytes", "kept_text", "n_removed", "n_spans", "kept_sha256", "_mark", "mark", "bad", "doc", "row", "_k0", "_c0",
            "_text", "score", "kept", "p", "rate", "copies", "n_tokens", "gid", "own", "n", "label", "fp", "_rate", "tag"]


def test_stages_take_columns_of_any_name(spark):
    """A column of each name that the stages use inside comes back as it was."""
    from pyspark.sql import functions as F
    docs = read_table(spark, SF, "documents").withColumns(
        {c: F.concat(F.lit(f"{c} "), "doc_id") for c in CLASHING})
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), "clash")
        assert docs.columns == [*read_table(spark, SF, "documents").columns, *CLASHING], name
        wrong = docs.where(" or ".join(f"not (`{c}` <=> concat('{c} ', doc_id))" for c in CLASHING))
        assert docs.count() > 0 and wrong.count() == 0, name
    assert P.STAGES[-1][1](spark, docs, SF).count() > 0
