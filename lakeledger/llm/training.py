"""Bounded samples of labelled rows, and small fits in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import stored

#: bounds of a training sample
ROWS_PER_CLASS = 4000
MAX_BYTES = 32 << 10
#: ids that are sent to every task; more meet the documents in a shuffle
SENT_IDS = 1_000_000


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % mod


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, train: Column, classes: list,
                    extra: list[str] | None = None, rows_per_class: int = ROWS_PER_CLASS,
                    max_bytes: int = MAX_BYTES) -> list:
    """Rows (text, label, *extra) to fit a model on: of each class the
    ``rows_per_class`` labelled ids with the least hash for which ``train``
    holds, without texts of over ``max_bytes``; of rows that share an id the
    text of least hash.  At most len(classes) x rows_per_class x max_bytes
    reach the driver.
    """
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.alias("label"), train.alias("ok"))
    lab = lab.where("ok and doc_id is not null and label is not null").select("doc_id", "label").distinct()
    ids = None
    for c in classes:
        some = lab.where(F.col("label") == F.lit(c)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        ids = some if ids is None else ids.unionByName(some)
    text = F.coalesce(F.col("text"), F.lit(""))
    extra = extra or []
    # own names, so that no column of the caller's can clash with them
    found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.struct(
                 F.lit(1), *[F.col(c) for c in extra]).alias("extra"))
             .where(F.octet_length("text") <= max_bytes).join(F.broadcast(ids), "doc_id")
             .groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text", "extra")).alias("m")))
    rows = found.select("doc_id", "m.text", "label", *[F.col(f"m.extra.{c}").alias(c) for c in extra]).collect()
    rows.sort(key=lambda r: (r[0], r[2], r[1]))
    return [tuple(r)[1:] for r in rows]


def labelled_rows(docs: DataFrame, labels: DataFrame, label: Column, train: Column, classes: list, extra: list[str]) -> DataFrame:
    """(doc_id, text, label, *extra) of all labelled ids for which ``train``
    holds, by the rules of :func:`labelled_sample` but without its bounds."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), label.alias("label"), train.alias("ok"))
    lab = lab.where("ok and doc_id is not null").where(F.col("label").isin(classes)).select("doc_id", "label").distinct()
    full = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.struct(F.lit(1), *[F.col(c) for c in extra]).alias("extra"))
    full = full.withColumn("h", F.xxhash64("text"))
    # texts move only where rows share an id and a text
    best = (full.select("doc_id", "h").join(lab, "doc_id").groupBy("doc_id", "label", "h").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("doc_id", "label").agg(F.min(F.struct("h", "n")).alias("b")).select("doc_id", "label", "b.h", "b.n"))
    # stored, so that the texts need not move where the ids are few
    best = stored(best, "labelled-ids")
    n, again = best.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()
    found = full.join(F.broadcast(best) if n <= SENT_IDS else best, ["doc_id", "h"])
    if again > 1:
        found = stored(found, "labelled-texts")
    rows = found.where("n = 1").select("doc_id", "label", F.struct("text", "extra").alias("m"))
    if again > 1:
        rows = rows.unionByName(found.where("n > 1").groupBy("doc_id", "label").agg(F.min(F.struct("text", "extra")).alias("m")))
    return rows.select("doc_id", "m.text", "label", *[F.col(f"m.extra.{c}").alias(c) for c in extra])


def row_sums(x: np.ndarray) -> np.ndarray:
    """The sum of each row, column after column, so that it depends on no
    other row."""
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += x[:, k]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression, by
    Newton steps; columns should be scaled."""
    x1 = np.c_[x, np.ones(len(x))]
    w = np.zeros(x1.shape[1])
    for _ in range(steps):
        p = sigmoid(x1 @ w)
        g = x1.T @ (weight * (p - y)) + ridge * np.r_[w[:-1], 0]
        h = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + np.diag(np.r_[np.full(len(w) - 1, ridge), 1e-9])
        step = np.linalg.solve(h, g)
        w -= step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    return w
