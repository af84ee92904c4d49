"""Links inside cells: every row against every row of its cell, in blocks.

A cell of more than ``BLOCK`` rows is dealt into blocks, and each pair of
blocks goes to a task of its own, so that a cell with a third of all rows is
compared by many tasks and none holds more than two blocks of it.  A task
emits a spanning forest of the links it found, never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.components import forest

BLOCK = 4096
AT_ONCE = 1 << 21  # pairs compared in one numpy call
HELD = 200_000     # rows gathered before their cells are compared


def block_pairs(rows: DataFrame, key: str, salt: str, block: int = BLOCK) -> DataFrame:
    """``rows`` whose cell has another row, each once for every block pair that
    needs it: columns lo, hi (the pair) and own (the row's block) are added."""
    size = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    many = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.col(salt), F.lit(7)), F.col("many")).cast("int")
    return (rows.join(size, key).withColumn("many", many).withColumn("own", own).drop("n")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("many") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .drop("many", "other"))


def _compare(cell: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray, val: np.ndarray,
             test: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows that are sorted by cell (a dense number)."""
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    sizes = np.diff(np.r_[starts, len(cell)])
    # row r meets the rows after it in its cell
    after = np.repeat(starts + sizes, sizes) - np.arange(len(cell)) - 1
    total = np.cumsum(after)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    at = 0
    while at < len(cell):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + AT_ONCE, "right")))
        cnt = after[at:to]
        left = np.repeat(np.arange(at, to), cnt)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(cnt) - cnt, cnt)
        ok = (lo[left] == hi[left]) | (own[left] != own[right])
        left, right = left[ok], right[ok]
        hit = test(val[left], val[right])
        if hit.any():
            out.append((val[left[hit]], val[right[hit]]))
            if sum(len(x[0]) for x in out) > AT_ONCE:
                out = [forest(np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]))]
        at = to
    if not out:
        return val[:0], val[:0]
    return forest(np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]))


def cell_links(rows: DataFrame, key: str, value: str, test: Callable) -> DataFrame:
    """Spanning edges (u, v) of the links among values that share a cell.

    ``test(a, b)`` says for two long arrays which pairs link.  Rows must be
    distinct in (key, value).
    """
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(whole: pd.DataFrame) -> pd.DataFrame:
            cell = whole["g"].to_numpy()
            new = np.r_[False, (cell[1:] != cell[:-1]) | (whole.lo.to_numpy()[1:] != whole.lo.to_numpy()[:-1])
                        | (whole.hi.to_numpy()[1:] != whole.hi.to_numpy()[:-1])]
            u, v = _compare(np.cumsum(new), whole.own.to_numpy(), whole.lo.to_numpy(), whole.hi.to_numpy(),
                            whole.val.to_numpy(), test)
            return pd.DataFrame({"u": u, "v": v})

        held: list[pd.DataFrame] = []
        count = 0
        for b in batches:
            held.append(b)
            count += len(b)
            if count >= HELD:
                whole = pd.concat(held, ignore_index=True)
                last = whole.iloc[-1]
                cut = int(((whole.g != last.g) | (whole.lo != last.lo) | (whole.hi != last.hi)).to_numpy().nonzero()[0].max(initial=-1)) + 1
                if cut:
                    yield links(whole.iloc[:cut])
                held, count = [whole.iloc[cut:]], len(whole) - cut
        if count:
            yield links(pd.concat(held, ignore_index=True))

    dealt = (block_pairs(rows, key, value)
             .select(F.xxhash64(key).alias("g"), "own", "lo", "hi", F.col(value).alias("val"))
             .repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi"))
    return dealt.mapInPandas(each, "u long, v long")
