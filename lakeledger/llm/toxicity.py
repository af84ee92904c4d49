"""Toxicity: a convolutional text classifier trained here in numpy.

A word is the sum of two rows of hashed embedding tables (two hashes, so
that a clean word that meets a toxic word in one table does not meet it in
the other).  Filters of width 1, 2 and 3 run over the words, each is pooled
by its maximum over the words of the whole text (a gap of zeros behind each
text keeps its last windows from the next one), and a logistic layer gives the score.
The first component of an embedding starts as the log odds of its bucket, the
rest at random; all weights are then trained by Adam.

All labelled training rows are learnt from.  Up to ``SHARD_ROWS`` of them are
trained on at once; more are dealt over shards of about that size, which Spark
trains in parallel; the result is the mean of the shards' weights.  The log
odds, the calibration and the thresholds come from counts over all rows.

A filter is linear before the pooling, so for scoring its taps are folded
into the tables: a text costs two table rows a word.

The score uses the text alone.  ``threshold`` is calibrated by language on
the training rows (the score of best F1, 0.5 for languages with few of
them), and ``flagged`` compares the score with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import slices, stored, text_bytes, wide
from lakeledger.llm.training import labelled_rows, logistic, row_sums, sigmoid
from lakeledger.llm.wordhash import mix, word_hashes

BUCKETS = 1 << 16
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 4
EPOCHS = 3         # at least so often over the rows,
STEPS = 400        # and so many minibatches
SMOOTH = 2         # texts of either class that every bucket counts besides its own
MIN_POSITIVE = 20  # rows of a class that a language needs for a threshold of its own
BATCH = 64
SHARD_ROWS = 8192  # rows, and bytes of text, that one process trains on
SHARD_BYTES = 64 << 20
COUNTED = 4000     # rows of a class that count in full for the balance of the classes
UNIT = 2.0 ** 40   # weights travel as whole numbers of 1 / UNIT: their sums depend on no order
BINS = 1024        # steps of the calibration's histogram in a unit of log odds
PAD = BUCKETS      # the row of the gaps between texts


def buckets(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """The two buckets of each word, with a gap of the widest filter after
    each text, and the first place and the one after the last word of each
    text; a text without words has one place, in its gap."""
    h, at = word_hashes(raw, off)
    gap = max(WIDTHS)
    place = np.arange(len(h)) + gap * (np.searchsorted(at, np.arange(len(h)), "right") - 1)
    n = len(h) + gap * (len(at) - 1)
    one, two = np.full(n, PAD, np.int32), np.full(n, PAD, np.int32)
    one[place] = h & np.uint64(BUCKETS - 1)
    two[place] = (h >> np.uint64(40)) & np.uint64(BUCKETS - 1)
    first = at[:-1] + gap * np.arange(len(at) - 1)
    return one, two, first, first + np.maximum(np.diff(at), 1)


def text_buckets(text: str) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return buckets(raw, np.array([0, len(raw)]))


class Model:
    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.emb = [np.r_[rng.normal(0, 0.05, (BUCKETS, DIM)), np.zeros((1, DIM))].astype(np.float32) for _ in range(2)]
        self.taps = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        for t in self.taps:
            t[:, 0, :] = np.abs(t[:, 0, :])
            t[0, 0, 0] = 1
        self.bias = np.full(len(WIDTHS) * FILTERS, -1, np.float32)
        self.out = np.full(len(WIDTHS) * FILTERS, 0.3, np.float32)
        self.const = np.float32(-2)
        self.scale = (1.0, 0.0)
        self.thresholds: dict[str, float] = {}

    def tables(self) -> list[np.ndarray]:
        """Embedding rows already multiplied by all taps of all filters."""
        taps = np.concatenate([t[j] for t in self.taps for j in range(len(t))], axis=1)
        return [e @ taps for e in self.emb]

    def pooled(self, tables: list[np.ndarray], one: np.ndarray, two: np.ndarray, first: np.ndarray,
               end: np.ndarray) -> np.ndarray:
        x = tables[0][one] + tables[1][two]
        words = np.c_[first, end].ravel()  # every second stretch is a gap
        out, col = [], 0
        for w in WIDTHS:
            act = x[:, col:col + FILTERS].copy()
            for j in range(1, w):
                act[:-j] += x[j:, col + j * FILTERS:col + (j + 1) * FILTERS]
            out.append(np.maximum.reduceat(act, words, axis=0)[::2])
            col += w * FILTERS
        return np.concatenate(out, axis=1)

    def logits(self, tables, one, two, first, end) -> np.ndarray:
        """Sums by row: a matrix product rounds a row by the rows around it."""
        hidden = np.maximum(self.pooled(tables, one, two, first, end) + self.bias, 0).astype(np.float64)
        return row_sums(hidden * self.out) + float(self.const)

    def score(self, tables, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        if len(off) < 2:
            return np.zeros(0)
        a, b = self.scale
        return sigmoid(a * self.logits(tables, *buckets(raw, off)) + b)

    def start(self, texts: list[tuple], y: np.ndarray) -> None:
        """Log odds of the buckets as the first component."""
        seen = np.zeros((2, 2, BUCKETS + 1))
        for t, label in zip(texts, y, strict=True):
            for k in range(2):
                seen[k, label, np.unique(t[k])] += 1
        self.start_from(seen, np.bincount(y, minlength=2))

    def start_from(self, seen: np.ndarray, rows: np.ndarray) -> None:
        """The same from the rows of either class and how many of them have
        each bucket of either table."""
        for k in range(2):
            rate = (seen[k] + SMOOTH) / (rows[:, None] + 2 * SMOOTH)
            self.emb[k][:, 0] = np.clip(np.log(rate[1] / rate[0]), -1, 4)
            self.emb[k][PAD] = 0

    def weights(self) -> np.ndarray:
        """All trained weights as rows of ``DIM``: the two tables, then the
        others, filled up with zeros."""
        rest = np.concatenate([*[t.ravel() for t in self.taps], self.bias, self.out, [self.const]])
        rest = np.r_[rest, np.zeros(-len(rest) % DIM)].reshape(-1, DIM)
        return np.concatenate([*self.emb, rest]).astype(np.float64)

    def set_weights(self, w: np.ndarray) -> None:
        n = BUCKETS + 1
        self.emb = [w[:n].astype(np.float32), w[n:2 * n].astype(np.float32)]
        rest, at = w[2 * n:].ravel().astype(np.float32), 0
        for p in (*self.taps, self.bias, self.out):
            p[...] = rest[at:at + p.size].reshape(p.shape)
            at += p.size
        self.const = np.float32(rest[at])

    def train(self, texts: list[tuple], y: np.ndarray, seed: int = 2, weight: tuple[float, float] = (1.0, 1.0)) -> None:
        """Adam over minibatches; the gradient of a maximum goes to its place.
        ``weight`` is that of a row of either class."""
        rng = np.random.default_rng(seed)
        params = [*self.taps, self.bias, self.out]
        mom = [np.zeros((2, *p.shape), np.float32) for p in params]
        const_m, step = np.zeros(2), 0
        epochs = max(EPOCHS, -(-STEPS * BATCH // len(texts)))
        total = epochs * -(-len(texts) // BATCH)
        by_class = np.asarray(weight)
        for _ in range(epochs):
            order = rng.permutation(len(texts))
            for at in range(0, len(order), BATCH):
                rows = order[at:at + BATCH]
                one = np.concatenate([texts[i][0] for i in rows])
                two = np.concatenate([texts[i][1] for i in rows])
                size = np.array([len(texts[i][0]) for i in rows])
                first = np.cumsum(size) - size
                words = np.maximum(size - max(WIDTHS), 1)
                x = self.emb[0][one] + self.emb[1][two]
                tops, pooled = [], []
                for t in self.taps:
                    act = x @ t[0]
                    for j in range(1, len(t)):
                        act[:-j] += x[j:] @ t[j]
                    top = np.array([s + act[s:s + n].argmax(axis=0) for s, n in zip(first, words, strict=True)])
                    tops.append(top)
                    pooled.append(np.take_along_axis(act, top, axis=0))
                pre = np.concatenate(pooled, axis=1) + self.bias
                hid = np.maximum(pre, 0)
                err = (sigmoid(hid @ self.out + self.const) - y[rows]) * by_class[y[rows]]
                err = err.astype(np.float32) / len(rows)
                grad = [np.zeros_like(t) for t in self.taps]
                d_pre = err[:, None] * self.out * (pre > 0)
                rate = 0.01 * (1 - step / total)
                for k, (t, top) in enumerate(zip(self.taps, tops, strict=True)):
                    d = d_pre[:, k * FILTERS:(k + 1) * FILTERS]
                    for j in range(len(t)):
                        place = np.minimum(top + j, len(x) - 1)
                        grad[k][j] = np.einsum("nf,nfd->df", d, x[place])
                        d_x = (d[:, :, None] * t[j].T[None]).reshape(-1, DIM)
                        for e, b in ((self.emb[0], one), (self.emb[1], two)):
                            np.subtract.at(e, b[place].ravel(), 20 * rate * d_x)
                            e[PAD] = 0
                step += 1
                for p, m, g in zip(params, mom, [*grad, d_pre.sum(0), hid.T @ err + 1e-4 * self.out], strict=True):
                    m[0] += 0.1 * (g - m[0])
                    m[1] += 0.01 * (g * g - m[1])
                    p -= (rate * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
                g = float(err.sum())
                const_m += [0.1 * (g - const_m[0]), 0.01 * (g * g - const_m[1])]
                self.const -= np.float32(rate * const_m[0] / (np.sqrt(const_m[1]) + 1e-6))


def without_copies(texts: list[tuple]) -> list[int]:
    """Places of the texts, of near copies the first alone: copies share the
    two least hashes of their word triples.  Else the words of a text with
    many copies look typical of its class."""
    seen, keep = set(), []
    for i, text in enumerate(texts):
        low = low_hashes(text)
        if not seen.intersection(low.tolist()):
            keep.append(i)
        seen.update(low.tolist())
    return keep


def low_hashes(text: tuple) -> np.ndarray:
    """The two least hashes of a text's word triples."""
    one, two = text[:2]
    h = one[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ two[1:-1].astype(np.uint64) * np.uint64(
        0xC2B2AE3D27D4EB4F) ^ one[2:].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    return np.unique(mix(h))[:2]


def best_threshold(score: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap among thresholds of best F1."""
    order = np.argsort(-score, kind="stable")
    s, hit = score[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(s) + 1) + y.sum())
    last = np.r_[s[1:] != s[:-1], True]
    f1 = np.where(last, f1, -1)
    k = int(np.argmax(f1))
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0)) / 2)


def fit(rows: list[tuple], share: float = 0.5) -> Model:
    """A model from rows (text, label 0 or 1, lang): four fifths train the
    network, the rest calibrate the score and the thresholds.  ``share`` is
    the share of label 1 among all labelled rows."""
    model = Model()
    model.rows = len(rows)
    if not rows or len({r[1] for r in rows}) < 2:
        model.out[:] = 0
        model.const = np.float32(4.0 if rows and rows[0][1] == 1 else -4.0)
        return model
    y = np.array([r[1] for r in rows], np.int64)
    texts = []
    for r in rows:
        texts.append(text_buckets(r[0]))
    keep = without_copies(texts)
    if len(np.unique(y[keep])) == 2:
        rows, texts, y = [rows[i] for i in keep], [texts[i] for i in keep], y[keep]
    cal = np.arange(len(rows)) % 5 == 4
    if len(np.unique(y[cal])) < 2 or len(np.unique(y[~cal])) < 2:
        cal[:] = True
        train = np.arange(len(rows))
    else:
        train = np.flatnonzero(~cal)
    model.start([texts[i] for i in train], y[train])
    model.train([texts[i] for i in train], y[train])
    tables = model.tables()
    logit = np.array([model.logits(tables, *t)[0] for t in texts], np.float64)
    # between the sample's balance and the labels' (the mean of the log odds):
    # a missed toxic text counts more than its share says
    odds = (y[cal].mean() / (1 - y[cal].mean()) * share / max(1 - share, 1e-9)) ** 0.5
    weight = np.where(y[cal] == 1, odds / (1 + odds) / y[cal].mean(), 1 / (1 + odds) / (1 - y[cal].mean()))
    a, b = logistic(logit[cal, None], y[cal], weight, ridge=0.1)
    model.scale = (float(max(a, 1e-3)), float(b))
    score = sigmoid(model.scale[0] * logit + model.scale[1])
    langs = np.array([r[2] or "" for r in rows])
    for lang in sorted(set(langs)):
        m = langs == lang
        if lang and y[m].sum() >= MIN_POSITIVE and (1 - y[m]).sum() >= MIN_POSITIVE:
            model.thresholds[str(lang)] = best_threshold(score[m], y[m])
    return model


def _each_text(rows: DataFrame, one, columns: list[str], schema: str) -> DataFrame:
    """``one(texts, columns)`` of the rows' texts as buckets, batch by batch."""
    names = schema.replace(",", " ").split()[::2]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1024):
            got = one([text_buckets(t) for t in b.column(0).to_pylist()], [b.column(k + 1) for k in range(len(columns))])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in got], names)
    return rows.select("text", *columns).mapInArrow(each, schema)


def _without_copies(rows: DataFrame) -> DataFrame:
    """As :func:`without_copies`, the rows in order of their ids.  Hashes and
    ids are stored, not the texts once more."""
    low = _each_text(rows, lambda texts, c: [*c, [low_hashes(t).view(np.int64).tolist() for t in texts]],
                     ["doc_id", "label"], "doc_id long, label int, low array<long>")
    low = stored(low.select("doc_id", "label", F.explode("low").alias("h")), "toxicity-low")
    me = F.struct("doc_id", "label")
    first = low.groupBy("h").agg(F.min(me).alias("first"))
    copies = stored(low.join(first, "h").where(me != F.col("first")).select("doc_id", "label").distinct(), "toxicity-copies")
    return rows.join(copies, ["doc_id", "label"], "left_anti")


def _class_rows(rows: DataFrame) -> np.ndarray:
    got = dict(rows.groupBy("label").count().collect())
    return np.array([got.get(0, 0), got.get(1, 0)])


def _seen(rows: DataFrame) -> np.ndarray:
    """How many texts of either class have each bucket of either table."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 2, BUCKETS + 1), np.int64)
        for b in slices(batches, 1024):
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                t = text_buckets(text)
                for k in range(2):
                    seen[k, label, np.unique(t[k])] += 1
        place = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(seen.ravel()[place])], ["place", "n"])

    got = rows.select("text", "label").mapInArrow(each, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(4 * (BUCKETS + 1))
    seen[got["place"].to_numpy()] = got["n"].to_numpy()
    return seen.reshape(2, 2, BUCKETS + 1)


def _train_shards(rows: DataFrame, model: Model, weight: tuple[float, float]) -> None:
    """Trains on each shard from the model's weights, and moves the weights by
    the mean of what the shards that meet them add."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def each(shard: pa.Table) -> pa.Table:
        own = Model()
        before = shipped.value.weights()
        own.set_weights(before)
        shard = shard.sort_by([("doc_id", "ascending"), ("label", "ascending")])
        own.train([text_buckets(t) for t in shard["text"].to_pylist()], shard["label"].to_numpy().astype(np.int64),
                  weight=weight)
        step = np.rint((own.weights() - before) * UNIT).astype(np.int64)
        place = np.flatnonzero(step.any(axis=1))
        return pa.table([pa.array(place), *[pa.array(step[place, k]) for k in range(DIM)]],
                        names=["place", *[f"d{k}" for k in range(DIM)]])

    steps = rows.groupBy("shard").applyInArrow(each, "place long, " + ", ".join(f"d{k} long" for k in range(DIM)))
    sums = steps.groupBy("place").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"d{k}").alias(f"d{k}") for k in range(DIM)]).toArrow()
    shipped.destroy()
    w = model.weights()
    w[sums["place"].to_numpy()] += np.stack([sums[f"d{k}"].to_numpy() for k in range(DIM)], axis=1) / UNIT / sums["n"].to_numpy()[:, None]
    model.set_weights(w)


def _calibrate(rows: DataFrame, model: Model, share: float) -> None:
    """The scale and the thresholds from histograms of the log odds over all
    rows, as :func:`fit` has them from its rows."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def score(texts: list[tuple], columns: list) -> list:
        tables = shipped.value.tables()
        logit = np.array([shipped.value.logits(tables, *t)[0] for t in texts], np.float64)
        return [*columns, np.rint(np.clip(logit, -40, 40) * BINS).astype(np.int64)]

    bins = _each_text(rows, score, ["label", "lang", "cal"], "label int, lang string, cal boolean, bin long")
    bins = stored(bins.groupBy("label", "lang", "cal", "bin").count(), "toxicity-bins")
    shipped.destroy()
    got = bins.where("cal").groupBy("label", "bin").agg(F.sum("count").alias("n")).orderBy("label", "bin").toArrow()
    y, x, n = (got[c].to_numpy().astype(np.float64) for c in ("label", "bin", "n"))
    counted = [min(COUNTED, n[y == c].sum()) for c in (0, 1)]
    mean = n[y == 1].sum() / n.sum()
    odds = (counted[1] / counted[0] * share / max(1 - share, 1e-9)) ** 0.5
    weight = n * np.where(y == 1, odds / (1 + odds) / mean, 1 / (1 + odds) / (1 - mean))
    a, b = logistic(x[:, None] / BINS, y, weight, ridge=0.1)
    model.scale = (float(max(a, 1e-3)), float(b))

    hits, misses = F.sum(F.when(F.col("label") == 1, F.col("count")).otherwise(0)), F.sum(F.when(F.col("label") == 0, F.col("count")).otherwise(0))
    at = bins.where("lang <> ''").groupBy("lang", "bin").agg(hits.alias("hit"), misses.alias("miss"))
    for c in ("hit", "miss"):
        at = at.withColumn(f"{c}_all", F.expr(f"sum({c}) OVER (PARTITION BY lang)"))
        at = at.withColumn(f"{c}_sum", F.expr(f"sum({c}) OVER (PARTITION BY lang ORDER BY bin DESC)"))
    at = at.withColumn("next", F.expr("lead(bin) OVER (PARTITION BY lang ORDER BY bin DESC)"))
    at = at.where(f"hit_all >= {MIN_POSITIVE} and miss_all >= {MIN_POSITIVE}")
    f1 = F.expr("2D * hit_sum / (hit_sum + miss_sum + hit_all)")
    best = at.groupBy("lang").agg(F.max_by(F.struct("bin", "next"), F.struct(f1, "bin")).alias("b"))
    of = lambda k: 0.0 if k is None else float(sigmoid(np.array(model.scale[0] * k / BINS + model.scale[1])))
    model.thresholds = {r[0]: (of(r[1]) + of(r[2])) / 2 for r in best.select("lang", "b.bin", "b.next").collect()}


def toxicity_model(docs: DataFrame, labels: DataFrame, train: Column) -> Model:
    """A model from all labelled rows for which ``train`` (over the labels'
    doc_id) holds."""
    share = labels.where(train).where("toxic in (0, 1)").agg(F.avg("toxic")).first()[0]
    share = 0.5 if share is None else float(share)
    rows = labelled_rows(docs, labels, F.col("toxic").cast("int"), train, [0, 1], ["lang"])
    rows = stored(rows.withColumn("lang", F.col("lang").cast("string")), "toxicity-rows")
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    if (n <= SHARD_ROWS and size <= SHARD_BYTES) or len(np.flatnonzero(_class_rows(rows))) < 2:
        few = rows if size <= SHARD_BYTES else rows.limit(1)  # of one class: nothing to train
        return fit([tuple(r)[1:] for r in sorted(few.collect(), key=lambda r: (r[0], r[2], r[1]))], share)
    kept = _without_copies(rows)
    shards = int(max(-(-n // SHARD_ROWS), -(-size // SHARD_BYTES)))
    dealt = [F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).alias("shard"),
             (F.pmod(F.xxhash64("doc_id", F.lit("cal")), F.lit(5)) == 4).alias("cal")]
    rows = (kept if _class_rows(kept).all() else rows).select("*", *dealt)
    if not _class_rows(rows.where("cal")).all() or not _class_rows(rows.where("not cal")).all():
        learn, rows = rows, rows.withColumn("cal", F.lit(True))
    else:
        learn = rows.where("not cal")
    model, of_class = Model(), _class_rows(learn)
    model.rows = int(n)
    model.start_from(_seen(learn), of_class)
    weight = np.minimum(COUNTED, of_class) / of_class
    weight = weight * of_class.sum() / (weight @ of_class)
    _train_shards(learn.select("shard", "doc_id", "label", "text"), model, tuple(weight))
    _calibrate(rows, model, share)
    return model


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, lang_threshold, flagged) for every row.

    Null and empty texts are scored as texts without words.  Repeated rows
    are scored alike; a null doc_id stays null; a null or unknown lang has the
    threshold 0.5; an empty table gives an empty result; other columns are
    ignored.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        tables = m.tables()
        for b in slices(batches, 128):
            score = m.score(tables, *text_bytes(b.column(1)))
            limit = np.array([m.thresholds.get(x, 0.5) for x in b.column(2).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(score, pa.float64()), pa.array(limit, pa.float64()), pa.array(score >= limit)],
                ["doc_id", "score", "lang_threshold", "flagged"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang"))
    return wide(rows).mapInArrow(each, "doc_id long, score double, lang_threshold double, flagged boolean")
