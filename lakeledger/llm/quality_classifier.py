"""Quality classifier by compression: zstandard dictionaries of good and bad text.

Two dictionaries are built from a bounded sample of labelled rows, one of
good and one of bad texts.  A text is compressed with each, the whole of it in
blocks of ``BLOCK`` bytes that know the dictionary alone (a longer block would
know the text's own words better than the dictionary's); the difference of the
two sizes, divided by the larger one, says which of the two it is more like.  A logistic curve fitted on the training rows turns this
normalised difference, and nothing else, into a calibrated score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import documents, slices, wide
from lakeledger.llm.training import labelled_sample, logistic, sigmoid

DICT_BYTES = 32 << 10
LEVEL = 3
BLOCK = 128
PART = 256  # sample texts go to the dictionary builder in parts of this size


def _dictionary(texts: list[bytes]) -> bytes:
    import zstandard

    parts = [t[i:i + PART] for t in texts for i in range(0, len(t), PART)]
    parts = [p for p in parts if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICT_BYTES, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples: the text itself is the dictionary
        return b"".join(texts)[-DICT_BYTES:]


class Compressors:
    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self.each = []
        for d in (good, bad):
            if len(d) >= 8:
                data = zstandard.ZstdCompressionDict(d)
                data.precompute_compress(level=LEVEL)
                self.each.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False))
            else:
                self.each.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))

        self.frame = [len(c.compress(b"")) for c in self.each]  # bytes of a block without content

    def size(self, which: int, text: bytes) -> int:
        compress, frame = self.each[which].compress, self.frame[which]
        return sum(len(compress(text[i:i + BLOCK])) - frame for i in range(0, len(text), BLOCK))

    def difference(self, texts: list[bytes]) -> np.ndarray:
        good, bad = (np.array([self.size(k, t) for t in texts], np.float64) for k in (0, 1))
        return (bad - good) / np.maximum(np.maximum(bad, good), 1)


class Model:
    good = bad = b""
    scale = 1.0    # of the difference
    curve = None   # slope and constant
    const = 1.0

    def score(self, use: Compressors, texts: list[bytes]) -> np.ndarray:
        if self.curve is None:
            return np.full(len(texts), self.const)
        return sigmoid(self.curve[0] * (use.difference(texts) / self.scale) + self.curve[1])


def fit(rows: list[tuple], share: float = 0.5) -> Model:
    """A model from rows (text, label 0 or 1): every second row builds the
    dictionaries, the others calibrate (the compressors know their own text
    too well).  ``share`` is the share of label 1 that they stand for."""
    model = Model()
    y = np.array([r[1] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        model.const = float(y[0]) if len(y) else 0.5
        return model
    texts = [r[0].encode("utf-8", "surrogatepass") for r in rows]
    # every second row of each class
    turn = np.zeros(len(y), np.int64)
    for c in (0, 1):
        turn[y == c] = np.arange(int((y == c).sum())) % 2
    model.good = _dictionary([t for t, c, k in zip(texts, y, turn, strict=True) if c == 1 and k == 0])
    model.bad = _dictionary([t for t, c, k in zip(texts, y, turn, strict=True) if c == 0 and k == 0])
    cal = np.flatnonzero(turn == 1)
    if len(np.unique(y[cal])) < 2:
        cal = np.arange(len(y))
    x = Compressors(model.good, model.bad).difference([texts[i] for i in cal])
    model.scale = float(x.std()) + 1e-6
    weight = np.where(y[cal] == 1, share / y[cal].mean(), (1 - share) / (1 - y[cal].mean()))
    slope, const = logistic((x / model.scale)[:, None], y[cal], weight, ridge=0.05)
    model.curve = max(float(slope), 0.0), float(const)
    return model


def quality_model(docs: DataFrame, labels: DataFrame, train: Column) -> Model:
    """A model from a bounded sample of the labelled rows for which ``train``
    holds, calibrated to the classes' shares in all of them."""
    share = labels.where(train).where("quality in (0, 1)").agg(F.avg("quality")).first()[0]
    return fit(labelled_sample(docs, labels, F.col("quality"), train, [0, 1]), 0.5 if share is None else float(share))


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row; higher means good text is likelier.

    Null and empty texts are compressed as empty.  Repeated rows are scored
    alike; a null doc_id stays null; an empty table gives an empty result;
    other columns are ignored.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        use = Compressors(m.good, m.bad)
        for b in slices(batches, 256):
            texts = b.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(m.score(use, texts), pa.float64())], ["doc_id", "score"])

    return wide(documents(docs)).mapInArrow(each, "doc_id long, score double")
