"""The corpus pipeline: quality rules, near-duplicates, repeated strings,
mixing to target weights and packing, over the whole documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and reread as the docs of the next one.  All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm import mixing, packing, quality_rules, simhash, suffix_dedup
from lakeledger.llm.common import read_table, stored
from lakeledger.session import apply_required_conf

#: shares of the mix; it holds as much clean text as there is
MIX = {"clean": 0.99, "toxic": 0.01, "poor": 0.0}
TIMES = 1.0


#: rows that go to a Python worker at once; at the default of 10,000 whole
#: documents a batch takes some 35 MB on either side
BATCH_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def _small_batches(spark: SparkSession) -> None:
    for k, v in BATCH_ROWS.items():
        spark.conf.set(k, v)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, 3 bits."""
    _small_batches(spark)
    return simhash.simhash_dedup(docs, shingle=3, max_bits=3)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur elsewhere."""
    _small_batches(spark)
    # the columns under private names, so that theirs cannot clash with the operator's
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("doc_id"), F.col("text"))
    left = suffix_dedup.deduplicate(named, [n for c, n in names.items() if c != "text"], length=200, with_text=True)
    cols = {c: F.col("kept_text") if c == "text" else F.col(n) for c, n in names.items()}
    if "n_chars" in cols:
        cols["n_chars"] = F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
    return left.select(*[x.alias(c) for c, x in cols.items()])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix to target weights takes them."""
    _small_batches(spark)
    model = mixing.domain_model(docs, read_table(spark, sf_dir, "labels"))
    return mixing.mixed_documents(docs, model, MIX, full="clean", times=TIMES)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 tokens.  The
    workers' memory goes back to whatever stage they serve next."""
    _small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), "word", end_id=1, room=4096,
                                  keep_memo=False)


STAGES = [("quality rules", quality), ("SimHash near-dedup", near_duplicates),
          ("suffix-array dedup", repeated_strings), ("mixing to target weights", mixture),
          ("best-fit packing", packed)]

#: SimHash (XXH64), suffix order and the trained mix have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is stored for the next."""
    apply_required_conf(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
