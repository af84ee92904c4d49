"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Equal vectors are folded first.  Spherical k-means, fitted on a bounded
sample, assigns each distinct vector to the cell of its nearest centre.  A
link may cross a border, so a vector also visits every cell in which a
vector linked to it can lie: with both on the unit sphere, a vector whose
nearest centre is c_j instead of the own c_i lies beyond the hyperplane half
way between them, and the angle to that plane must not exceed the angle of
the threshold.  So no link is lost, whatever the clusters look like.

In a cell the vectors at home are compared with all vectors there, in blocks:
a task holds one block of each.  Vectors are turned to the principal axes of the
sample; the product of the leading coordinates plus the product of the lengths
of the rest is an upper bound of the cosine (Cauchy-Schwarz), and the pairs
whose bound reaches the threshold get their cosine in double precision, by
whole rows where many do.  A task emits the weighted count of links for each
row and a spanning forest of the links, never the pairs.  A large cell is more block pairs, so a
cell with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import stored
from lakeledger.llm.components import connected_components, roots

SAMPLE = 16_384      # vectors the centres are fitted on, at most
CELL = 8192          # distinct vectors a cell should hold
MAX_CELLS = 1024
BLOCK = 4096         # rows of a block of a cell
LEAD = 16            # coordinates of the bound
MANY = 0.02          # share of pairs from which the whole product is formed
ROUNDS = 12


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("nd,nd->n", vectors, vectors))[:, None]


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """k unit centres of unit rows."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.linalg.norm(total, axis=1)
        c = np.where(size[:, None] > 1e-9, total / np.maximum(size, 1e-9)[:, None], c)
    return c


def cells_of(x: np.ndarray, centers: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell, home) for every cell that a row is in or visits."""
    dot = x @ centers.T
    home = dot.argmax(axis=1)
    between = np.linalg.norm(centers[:, None] - centers[None], axis=2)[home]
    slack = np.sin(np.arccos(min(1.0, threshold))) + 1e-9
    visits = dot[np.arange(len(x)), home][:, None] - dot <= slack * between
    visits[np.arange(len(x)), home] = True
    row, cell = np.nonzero(visits)
    return row, cell, cell == home[row]


def axes(x: np.ndarray) -> np.ndarray:
    """The leading principal axes of unit rows, as columns."""
    _, vectors = np.linalg.eigh(x.T @ x)
    return vectors[:, ::-1][:, :LEAD]


def linked(a: np.ndarray, b: np.ndarray, lead: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) of unit rows with a cosine of at least
    ``threshold``."""
    if lead is not None:
        short = []
        for x in (a, b):
            y = x @ lead
            rest = np.sqrt(np.maximum(0, 1 - np.einsum("nd,nd->n", y, y)))
            short.append(np.c_[y, rest].astype(np.float32))
        i, j = np.nonzero(short[0] @ short[1].T >= threshold - 1e-4)
        if len(i) <= MANY * len(a) * len(b):
            keep = [np.einsum("nd,nd->n", a[i[s:s + 65536]], b[j[s:s + 65536]]) >= threshold
                    for s in range(0, len(i), 65536)]
            keep = np.concatenate(keep) if keep else np.zeros(0, bool)
            return i[keep], j[keep]
    return np.nonzero(a @ b.T >= threshold)


def _rows(column) -> np.ndarray:
    """The unit rows of an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit_rows(flat.reshape(len(column), -1))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(node, embedding, dim, least, n) of the distinct usable vectors: not
    null, of finite components that are not all zero."""
    v = F.col("embedding")
    good = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = v.isNotNull() & good & F.exists(v, lambda x: x != 0)
    ok = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(good)
    once = ok.groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    # a name even where all ids are null
    name = F.coalesce(F.col("least").cast("string"), F.md5(F.array_join(v.cast("array<string>"), ",")))
    return once.select(name.alias("node"), "embedding", F.size(v).alias("dim"), "least", "n")


def embedding_groups(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Vectors link at a cosine of at least ``threshold``, computed in double
    precision; n_links counts the other rows linked directly, component_id is
    the least vec_id reachable, kept marks the row that names its group.
    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing, and vectors of different lengths do not link.  Repeated
    rows are rows of their own: equal vectors link with each other.  Rows with
    a null vec_id count as links and get the component of their group (null
    if no row of it has an id) but are never kept.  An empty table gives an
    empty result; other columns are ignored.
    """
    once = stored(distinct_vectors(vectors), "vectors")
    count = once.count()
    sizes = [r[0] for r in once.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).collect()]
    main = sizes[0] if sizes else 0
    sample = [r[0] for r in once.where(F.col("dim") == main).orderBy(F.xxhash64("node")).limit(SAMPLE)
              .select("embedding").collect()]
    k = max(1, min(MAX_CELLS, count // CELL, len(sample)))
    sample = unit_rows(np.array(sample, np.float64).reshape(len(sample), main))
    centers = spherical_kmeans(sample, k) if k > 1 else None
    lead = axes(sample) if main > 2 * LEAD else None
    del sample
    fit = once.sparkSession.sparkContext.broadcast((centers, main, lead))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centers, main, _ = fit.value
        for b in batches:
            dim = b["dim"].to_numpy()
            # vectors of other lengths than the main one: one cell a length
            row = np.flatnonzero(dim != main) if centers is not None else np.arange(len(b))
            parts = [(row, -dim[row].astype(np.int64), np.ones(len(row), bool))]
            if centers is not None and (dim == main).any():
                own = np.flatnonzero(dim == main)
                for at in range(0, len(own), 1024):
                    some = own[at:at + 1024]
                    r, c, h = cells_of(unit_rows(_matrix(b.embedding.iloc[some])), centers, threshold)
                    parts.append((some[r], c, h))
            row = np.concatenate([p[0] for p in parts])
            yield pd.DataFrame({"node": b.node.to_numpy()[row], "cell": np.concatenate([p[1] for p in parts]),
                                "home": np.concatenate([p[2] for p in parts])})

    placed = stored(once.select("node", "embedding", "dim").mapInPandas(
        place, "node string, cell long, home boolean"), "cells")
    size = placed.groupBy("cell").agg(F.count("*").alias("members"), F.count_if("home").alias("homes"))
    n_m = F.ceil(F.col("members") / BLOCK).cast("int")
    n_h = F.greatest(F.lit(1), F.ceil(F.col("homes") / BLOCK)).cast("int")
    spot = F.xxhash64("node", F.lit(3))
    # every member goes to all home blocks once, as a column of the product;
    # those at home also to all member blocks, as a row of it
    both = placed.join(size, "cell").where("homes > 0").select(
        "node", "cell", "home", n_m.alias("n_m"), n_h.alias("n_h"), spot.alias("spot"))
    columns = both.select("node", "cell", F.lit(False).alias("is_row"), F.pmod("spot", "n_m").cast("int").alias("mb"),
                          F.explode(F.sequence(F.lit(0), F.col("n_h") - 1)).alias("hb"))
    rows = both.where("home").select("node", "cell", F.lit(True).alias("is_row"),
                                     F.explode(F.sequence(F.lit(0), F.col("n_m") - 1)).alias("mb"),
                                     F.pmod("spot", "n_h").cast("int").alias("hb"))
    dealt = rows.unionByName(columns).join(once.select("node", "embedding", "n"), "node")

    def product(table: pa.Table) -> pa.Table:
        _, main, lead = fit.value
        is_row = table.column("is_row").to_numpy()
        parts = [table.filter(pa.array(m)) for m in (is_row, ~is_row)]
        if not len(parts[0]) or not len(parts[1]):
            return schema.empty_table()
        a, b = (_rows(p.column("embedding")) for p in parts)
        i, j = linked(a, b, lead if a.shape[1] == main else None, threshold)
        an, bn = (p.column("node").to_numpy() for p in parts)
        other = an[i] != bn[j]
        i, j = i[other], j[other]
        count = np.bincount(i, weights=parts[1].column("n").to_numpy()[j], minlength=len(an)).astype(np.int64)
        codes, names = pd.factorize(np.concatenate([an, bn]))
        low = roots(codes[:len(an)][i], codes[len(an):][j], len(names))
        tree = np.flatnonzero(low != np.arange(len(names)))
        hit = np.flatnonzero(count)
        return pa.Table.from_arrays(
            [pa.array([*an[hit], *[None] * len(tree)], pa.string()), pa.array([*count[hit], *[0] * len(tree)], pa.int64()),
             pa.array([*[None] * len(hit), *names[tree]], pa.string()),
             pa.array([*[None] * len(hit), *names[low[tree]]], pa.string())], schema=schema)

    schema = pa.schema([("node", pa.string()), ("links", pa.int64()), ("u", pa.string()), ("v", pa.string())])
    found = stored(dealt.groupBy("cell", "hb", "mb").applyInArrow(
        product, "node string, links long, u string, v string"), "links")
    links = found.where("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected_components(found.where("u is not null").select("u", "v"))
    named = (once.join(comp, "node", "left").join(links, "node", "left")
             .select("embedding", "least", "n", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("component", "node").alias("component")))
    named = stored(named, "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    known = named.join(least, "component").select(
        F.col("embedding").alias("_e"), (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id",
        F.lit(True).alias("_usable"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").join(
        known, F.col("embedding") == F.col("_e"), "left")
    own = F.when(F.col("_usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), own.alias("component_id"),
                      F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
