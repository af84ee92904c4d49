"""Small tables with the awkward rows every operator must take."""

import random

from pyspark.sql import functions as F

WORDS = "the of and loser einen être niño word text lorem ipsum dolor sit amet data spark row page".split()


def awkward_texts(seed=3, n=60):
    """(doc_id, text): nulls, empty and blank texts, one-word texts, copies,
    near copies, repeated rows, a very long text and odd characters."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(rng.randrange(1, 90)))
             for _ in range(n)]
    for i in range(0, n // 3):
        words = texts[i].split(" ")
        words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += texts[:8] + ["", " \n\t ", "one", "two words", None, None, "a\n\nb  c\x0b d", "x" * 400, "ab " * 700,
                          "é" * 150 + " ß日本語 " * 40, " ".join(WORDS * 300), "same line\n" * 30 + "end"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, texts[6]), (None, None)]


def docs_table(spark, rows, parts=3):
    """A documents table with extra columns whose names operators use inside."""
    full = [(i, t, ["en", "de", None][k % 3], f"src{k % 2}" if k % 7 else None, None if t is None else len(t), 1.5, "x", k)
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long, score double, row string, kept int"
    ).repartition(parts, F.col("kept"))


def empty_docs(spark):
    return docs_table(spark, [(1, "a")]).where("doc_id < 0")
