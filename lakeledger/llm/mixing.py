"""Mixing to target weights with soft membership.

A classifier trained on the labelled rows gives each document a posterior over
domains (here clean, toxic and poor text, from the labels table).  Every
document gets a rate, zero or more: how often it is to be taken.  The rates
are fitted by distributed projected-gradient least squares on the gaps between
the expected tokens of the domains under the rates and their targets,

    gap_k = sum over documents d of rate_d tokens_d p_dk - target_k,    least gap' W gap,  rate >= 0,

from rate 1 on, with W the inverse of the second moments, sum of tokens p p', of
the documents that have a rate left: domains that overlap then pull as strongly
as others.  A step goes against the gradient, scaled by the documents' tokens,
and back to zero where a rate would be negative:

    rate_d  <-  max(0, rate_d - size p_d . (W gap)).

Without the bound one step of size 1 would meet all targets.  A step that does
not lessen the squared gaps is halved; the fit ends when each domain is within
``TOLERANCE`` of its target or no step helps, and a warning names the totals of
a mix that misses them.  A step is k numbers on the driver and one aggregation
of a stored table (tokens, posteriors): partial sums before the shuffle, some
ten numbers back.  The rate is a function of the posterior and the steps, so it
is stored once in ``STORE`` steps only.

A target of zero cannot be met while other domains' documents leave some
doubt, and pressing it on would leave only the few documents with the least
doubt, many times each; so a domain with target zero is aimed at ``LEAST`` of
what it holds.

The classifier is a softmax over, for each domain, the mean and maximum over
the words of the domain's log odds (hashed words), and a few rates of the
text's shape (letters in capitals, symbols, words equal to the one before).
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import slices, stored, text_bytes, wide
from lakeledger.llm.training import labelled_sample, row_sums
from lakeledger.llm.wordhash import SPACE, word_hashes

DOMAINS = ("clean", "toxic", "poor")
BUCKETS = 1 << 16
SMOOTH = 2.0
SAMPLE = 2000      # labelled rows of a domain, at most
TOLERANCE = 1e-4   # gap that counts as none, of a domain's target
LEAST = 0.3        # of its tokens at which a domain with target zero is aimed
MAX_STEPS = 100
STORE = 20         # steps after which the rates so far are stored

_UPPER = np.zeros(256)
_UPPER[65:91] = 1
_SYMBOL = np.zeros(256)
_SYMBOL[list(b"!#$%&*<>|@^~{}[]=+\\/_")] = 1


def domain_of_labels() -> Column:
    """The domain of a labels row: toxic before poor before clean; null where a
    label that decides is missing."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor")
            .when((F.col("toxic") == 0) & (F.col("quality") == 1), "clean"))


class DomainModel:
    """Posterior over ``domains`` for the texts of a batch."""

    def __init__(self, domains: tuple[str, ...] = DOMAINS):
        self.domains = domains
        self.odds = np.zeros((BUCKETS, len(domains)), np.float32)
        self.weights = np.zeros((2 * len(domains) + 5, len(domains)))
        self.center, self.scale = np.zeros(len(self.weights) - 1), np.ones(len(self.weights) - 1)
        self.seen = np.zeros(len(domains))   # rows of each domain that the softmax was fitted on
        self.shift = np.zeros(len(domains))  # from their shares to those of all labelled rows

    def features(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, words of each text)."""
        h, at = word_hashes(raw, off, SPACE)
        n, size = np.diff(at), np.diff(off)
        full = n > 0
        k = len(self.domains)
        x = np.zeros((len(n), 2 * k + 4))
        if len(h):
            o = self.odds[(h & np.uint64(BUCKETS - 1)).astype(np.int64)]
            first = at[:-1][full]
            x[full, :k] = np.add.reduceat(o, first, axis=0, dtype=np.float64) / n[full, None]
            x[full, k:2 * k] = np.maximum.reduceat(o, first, axis=0)
            same = np.r_[False, h[1:] == h[:-1]].astype(np.float64)
            same[first] = 0
            x[full, 2 * k] = np.add.reduceat(same, first) / n[full]
            some = size > 0
            for j, table in enumerate((_UPPER, _SYMBOL)):
                x[some, 2 * k + 1 + j] = np.add.reduceat(table[raw], off[:-1][some]) / size[some]
        x[:, 2 * k + 3] = np.log1p(n)
        return x, n

    def posterior(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.center) / self.scale, -10, 10)
        z = np.stack([row_sums(x * w) for w in self.weights[:-1].T], axis=1) + self.weights[-1] + self.shift
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / row_sums(p)[:, None]

    def fit(self, rows: list[tuple]) -> DomainModel:
        """From rows (text, domain).  Odds come from every second row of a
        domain, the softmax from the others (the first is one of them); without
        rows the posterior is uniform."""
        if not rows:
            return self
        def raw(i: int) -> tuple[np.ndarray, np.ndarray]:
            text = np.frombuffer(rows[i][0].encode("utf-8", "surrogatepass"), np.uint8)
            return text, np.array([0, len(text)])

        y = np.array([self.domains.index(r[1]) for r in rows])
        k = len(self.domains)
        half = np.zeros(len(rows), bool)
        for c in range(k):
            half[np.flatnonzero(y == c)[1::2]] = True
        seen = np.full((k, BUCKETS), 0.0)
        for i in np.flatnonzero(half):
            h, _ = word_hashes(*raw(i), SPACE)
            seen[y[i], np.unique(h & np.uint64(BUCKETS - 1)).astype(np.int64)] += 1
        n = np.bincount(y[half], minlength=k)
        for c in range(k):
            mine = (seen[c] + SMOOTH) / (n[c] + 2 * SMOOTH)
            rest = (seen.sum(0) - seen[c] + SMOOTH) / (n.sum() - n[c] + 2 * SMOOTH)
            self.odds[:, c] = np.clip(np.log(mine / rest), -1, 4)
        use = np.flatnonzero(~half)
        self.seen = np.bincount(y[use], minlength=k)
        x = np.concatenate([self.features(*raw(i))[0] for i in use])
        self.center, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = np.c_[np.clip((x - self.center) / self.scale, -10, 10), np.ones(len(x))]
        goal = np.eye(k)[y[use]]
        step = 2.0 / max(np.linalg.eigvalsh(z.T @ z / len(z))[-1], 1e-9)
        w = prev = np.zeros_like(self.weights)
        for t in range(1500):  # accelerated gradient descent
            v = w + (t / (t + 3)) * (w - prev)
            s = z @ v
            s = np.exp(s - s.max(axis=1, keepdims=True))
            s /= s.sum(axis=1, keepdims=True)
            prev, w = w, v - step * (z.T @ (s - goal) / len(z) + 1e-4 * v)
        self.weights = w
        return self


def domain_model(docs: DataFrame, labels: DataFrame, domains: tuple[str, ...] = DOMAINS) -> DomainModel:
    """A model from a bounded sample of the labelled rows of ``docs``, with the
    domains' shares in all of these as prior.  Labels of documents that are not
    in ``docs`` count nowhere; a domain without a row has posterior zero."""
    model = DomainModel(domains)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    lab = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain_of_labels().alias("label"))
           .where(F.col("label").isin(*domains)).distinct())
    lab = stored(ids.join(lab, "doc_id"), "labels")  # a row for each labelled document
    sample = labelled_sample(docs, lab, F.col("label"), F.lit(True), list(domains), rows_per_class=SAMPLE)
    model.fit(sample)
    there = dict(lab.groupBy("label").count().collect())
    if sample:
        model.shift = np.array([np.log(there[d] / n) if n else -np.inf
                                for d, n in zip(domains, model.seen.tolist(), strict=True)])
    return model


def memberships(docs: DataFrame, model: DomainModel, keep: list[str]) -> DataFrame:
    """The columns ``keep``, n_tokens (words) and p (posteriors, in the order
    of the model's domains) for every row; null text counts as empty."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    k = len(model.domains)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        for b in slices(batches, 128):
            x, n = m.features(*text_bytes(b.column(0)))
            p = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * k),
                                         pa.array(m.posterior(x).ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(n.astype(np.int64)), p],
                                             [*keep, "n_tokens", "p"])

    rows = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("_text"), *keep)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return wide(rows).mapInArrow(each, f"{kinds}, n_tokens long, p array<double>")


def fit_rates(members: DataFrame, domains: tuple[str, ...], weights: dict[str, float],
              total: float | None = None, full: str | None = None, times: float = 1.0) -> list[list[float]]:
    """The steps over a table with n_tokens and p: for each one what a domain's
    posterior takes from the rate.

    ``weights``: the share of each domain in the mix (scaled to sum 1).
    ``total``: tokens of the whole mix; by default those that are there.
    ``full``: instead of a total, a domain of which the mix is to hold
    ``times`` the tokens that are there.  Domains without any posterior mass
    are left out of the fit; an empty table needs no steps.
    """
    cur = stored(members.select("n_tokens", "p", F.lit(1.0).alias("_rate")), "members")
    k = len(domains)
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]

    def sums(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the domains after the steps behind the stored rates, and
        the second moments of the documents whose rate is not zero."""
        n, p, rate = F.col("n_tokens"), F.col("p"), F.col("_now")
        live = F.when(rate > 0, n)
        row = cur.withColumn("_now", rate_of(p, steps, F.col("_rate"))).agg(*[
            F.coalesce(F.sum(x), F.lit(0.0)) for x in (
                *[rate * n * p[i] for i in range(k)], *[live * p[i] * p[j] for i, j in pairs])]).first()
        moment = np.zeros((k, k))
        for (i, j), v in zip(pairs, row[k:], strict=True):
            moment[i, j] = moment[j, i] = v
        return np.array(row[:k], float), moment

    held, moment = sums([])
    got = held
    there = sum(weights.values())
    share = [weights.get(d, 0.0) / there for d in domains]
    if full is not None:
        total = times * held[domains.index(full)] / share[domains.index(full)]
    goal = np.array([s * (held.sum() if total is None else total) for s in share])
    aim = np.where(goal > 0, goal, LEAST * held)
    on = held > 0
    first = np.linalg.pinv(moment[np.ix_(on, on)])
    loss = lambda x: float((x - aim)[on] @ first @ (x - aim)[on])
    met = lambda x: bool((np.abs(x - aim) <= TOLERANCE * np.maximum(aim, goal.sum() * TOLERANCE))[on].all())
    steps: list[list[float]] = []
    since: list[list[float]] = []
    tries = 0
    while not met(got) and tries < MAX_STEPS:
        pull = np.zeros(k)
        # the moments of the live documents, kept away from singular by those of all
        pull[on] = np.linalg.pinv(moment[np.ix_(on, on)] + 1e-9 * np.diag(held[on])) @ (got - aim)[on]
        size, better = 1.0, False
        while not better and size > 1e-3 and tries < MAX_STEPS:
            tries += 1
            now, new = sums([*since, (size * pull).tolist()])
            better = loss(now) < loss(got) * (1 - 1e-9)
            if not better:
                size /= 2
        if not better:
            break
        since.append((size * pull).tolist())
        steps.append(since[-1])
        got, moment = now, new
        if len(since) == STORE:
            cur = stored(cur.withColumn("_rate", rate_of(F.col("p"), since, F.col("_rate"))), "members")
            since = []
    if not bool((np.abs(got - goal) <= TOLERANCE * np.maximum(goal, goal.sum()))[on].all()):
        warnings.warn("the mix misses its targets: " + ", ".join(
            f"{d} {g:.6g} tokens, target {t:.6g}" for d, g, t, ok in zip(domains, got, goal, on, strict=True) if ok),
            stacklevel=2)
    return steps


def rate_of(p: Column, steps: list[list[float]], start: Column | None = None) -> Column:
    """The rate of a document with posterior p after the steps from ``start``, by default 1."""
    rate = F.lit(1.0) if start is None else start
    for step in steps:
        move = sum((p[i] * F.lit(e) for i, e in enumerate(step)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
    return rate


def taken(rates: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add copies to a table with rate: the rate rounded up or down by a hash
    of the key, so that the expected number of copies is the rate and every run
    takes the same."""
    u = F.pmod(F.xxhash64(F.lit("mix"), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return rates.withColumn("copies", F.floor(F.col("rate") + u).cast("int"))


def mix(docs: DataFrame, model: DomainModel, weights: dict[str, float], keep: list[str],
        full: str | None = None, times: float = 1.0) -> DataFrame:
    """The columns ``keep``, n_tokens, p, rate and copies of every row.

    Null and empty texts carry no tokens; their rate follows from their
    posterior like any other.  Repeated rows and rows with a null id are rows
    of their own (equal ids are rounded alike).  An empty table gives an empty
    result; other columns are ignored.
    """
    members = memberships(docs, model, keep)
    steps = fit_rates(members, model.domains, weights, full=full, times=times)
    return taken(members.withColumn("rate", rate_of(F.col("p"), steps)))


def mixed_documents(docs: DataFrame, model: DomainModel, weights: dict[str, float],
                    full: str | None = None, times: float = 1.0) -> DataFrame:
    """The documents of the mix: each row as often as its copies say, all
    columns as they came."""
    named = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(docs.columns)],
                        F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    out = mix(named, model, weights, [*[f"_c{i}" for i in range(len(docs.columns))], "doc_id"], full, times)
    return (out.where("copies > 0").withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)]))
