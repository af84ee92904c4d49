"""Held-out accuracy of the trained models, and the awkward rows."""

import numpy as np
import pytest
from llm.helpers import awkward_texts, docs_table, empty_docs
from pyspark.sql import functions as F

from lakeledger.llm import mixing, quality_classifier, queries, toxicity, training

SF = "/root/testdata/sf0.1"


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    return (rank[y == 1].mean() - (y.sum() - 1) / 2) / (len(y) - y.sum())


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").distinct()


def held_out(spark, labels, name, label):
    rows = queries.QUERIES[name](spark, SF).join(labels, "doc_id").where("held_out").toPandas()
    return rows.score.to_numpy(), rows[label].to_numpy(), rows.predicted.to_numpy()


def test_toxicity_held_out(spark, labels):
    score, y, predicted = held_out(spark, labels, "op3_toxicity", "toxic")
    # some 300 toxic texts in four languages to learn from
    assert auc(score, y) > 0.92
    assert predicted[y == 1].mean() > 0.6 and predicted[y == 0].mean() < 0.02


def test_quality_held_out(spark, labels):
    score, y, predicted = held_out(spark, labels, "op7_quality_classifier", "quality")
    # the normalised difference alone, some 200 bad texts in the dictionary
    assert auc(score, y) > 0.95
    assert predicted[y == 1].mean() > 0.95 and predicted[y == 0].mean() < 0.2


def test_held_out_rows_and_labels_are_not_inputs(spark):
    """Scores depend on the text alone: equal texts have equal scores."""
    out = queries.QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    assert out.groupBy("text").agg(F.countDistinct("score").alias("n")).where("n > 1").count() == 0
    assert out.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 5 = 0)").count() == 0


def some_labels(spark, rows):
    return spark.createDataFrame(
        [(i, k % 2, (k // 2) % 2) for k, (i, _) in enumerate(rows)] + [(10**9, 1, 0), (None, 0, 1), (1, None, None)],
        "doc_id long, quality int, toxic int")


def test_awkward_rows(spark):
    rows = awkward_texts()
    docs = docs_table(spark, rows)
    labels = some_labels(spark, rows)
    for frame in (toxicity.toxicity(docs, toxicity.toxicity_model(docs, labels, F.lit(True))),
                  quality_classifier.quality(docs, quality_classifier.quality_model(docs, labels, F.lit(True)))):
        got = frame.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert sum(r.doc_id is None for r in got) == 2


def test_without_labels_or_documents(spark):
    docs = docs_table(spark, awkward_texts())
    none = some_labels(spark, []).where("doc_id < 0")
    assert toxicity.toxicity(docs, toxicity.toxicity_model(docs, none, F.lit(True))).where("score > 0.5").count() == 0
    assert quality_classifier.quality(docs, quality_classifier.quality_model(docs, none, F.lit(True))).count() == docs.count()
    empty = empty_docs(spark)
    model = toxicity.toxicity_model(empty, none, F.lit(True))
    assert toxicity.toxicity(empty, model).collect() == []
    mixed = mixing.mix(empty, mixing.domain_model(empty, none), {"clean": 1.0}, ["doc_id"])
    assert mixed.collect() == []


def test_pooling_equals_plain_convolution():
    """The folded tables against a convolution written out."""
    model = toxicity.Model(seed=3)
    rng = np.random.default_rng(0)
    text = " ".join(rng.choice(["a", "bb", "ccc", "dd", "e"], 50)).encode()
    raw = np.frombuffer(text, np.uint8)
    one, two, first, end = toxicity.buckets(raw, np.array([0, len(raw)]))
    assert (first.tolist(), end.tolist()) == ([0], [50])
    x = (model.emb[0][one] + model.emb[1][two])[:50]
    want = []
    for t in model.taps:
        act = [sum(x[i + j] @ t[j] for j in range(len(t)) if i + j < len(x)) for i in range(len(x))]
        want.append(np.max(act, axis=0))
    got = model.pooled(model.tables(), one, two, first, end)[0]
    assert np.allclose(got, np.concatenate(want), atol=1e-5)


def test_thresholds_by_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.toxicity_model(docs, labels, F.lit(True))
    assert "en" in model.thresholds and all(0 <= t <= 1 for t in model.thresholds.values())
    out = toxicity.toxicity(docs.where("doc_id < 300"), model)
    assert out.where("flagged <> (score >= lang_threshold)").count() == 0


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.2, 0.2, 0.2], 400)
    tokens = rng.integers(0, 500, 400)
    members = spark.createDataFrame([(i, int(t), [float(v) for v in q]) for i, (t, q) in enumerate(zip(tokens, p, strict=True))],
                                    "doc_id long, n_tokens long, p array<double>")
    weights = {"a": 0.7, "b": 0.2, "c": 0.1}
    steps = mixing.fit_rates(members, ("a", "b", "c"), weights)
    got = members.withColumn("rate", mixing.rate_of(F.col("p"), steps)).toPandas()
    rate = np.ones(400)
    for step in steps:  # the descent written out
        rate = np.maximum(0, rate - p @ np.array(step))
    assert np.allclose(got.sort_values("doc_id").rate, rate)
    held = (rate * tokens) @ p
    assert np.allclose(held / held.sum(), [0.7, 0.2, 0.1], atol=2e-3) and (rate >= 0).all()


def test_unreachable_targets_give_the_nearest_mix(spark):
    members = spark.createDataFrame([(1, 10, [0.5, 0.5]), (2, 10, [0.5, 0.5])], "doc_id long, n_tokens long, p array<double>")
    steps = mixing.fit_rates(members, ("a", "b"), {"a": 0.8, "b": 0.2})
    rates = [r.rate for r in members.withColumn("rate", mixing.rate_of(F.col("p"), steps)).collect()]
    assert np.allclose(rates, [1.0, 1.0])  # both domains are equally wrong


def test_overlapping_domains_reach_their_targets(spark):
    rng = np.random.default_rng(5)
    poor = np.where(rng.random(2000) < 0.14, rng.normal(0.30, 0.1, 2000), rng.normal(0.1, 0.1, 2000)).clip(0.001, 0.999)
    members = spark.createDataFrame([(100, [1 - float(x), float(x)]) for x in poor], "n_tokens long, p array<double>")
    steps = mixing.fit_rates(members, ("a", "b"), {"a": 0.97, "b": 0.03})
    got = members.withColumn("rate", mixing.rate_of(F.col("p"), steps)).agg(
        *[F.sum(F.col("rate") * F.col("n_tokens") * F.col("p")[i]) for i in (0, 1)]).first()
    assert np.allclose(got, [0.97 * 200_000, 0.03 * 200_000], rtol=2e-4)


def test_missed_targets_are_reported(spark):
    members = spark.createDataFrame([(10, [0.5, 0.5])], "n_tokens long, p array<double>")
    with pytest.warns(UserWarning, match="misses its targets: a 5 tokens, target 8, b 5 tokens, target 2"):
        mixing.fit_rates(members, ("a", "b"), {"a": 0.8, "b": 0.2})


def test_domains_are_learnt_from_the_documents_there(spark):
    """Labels of documents that are gone neither fill the sample nor count in
    the prior, and a domain without a document leaves the others theirs."""
    rng = np.random.default_rng(2)
    word = lambda c: " ".join(rng.choice([f"{c}{i}" for i in range(9)], 40))
    docs = [(i, word("c")) for i in range(300)] + [(i, word("p")) for i in range(300, 330)]
    labels = spark.createDataFrame(
        [(i, 0, int(i < 300)) for i, _ in docs] + [(i, 0, 0) for i in range(1000, 41_000)] + [(50_000, 1, 1)],
        "doc_id long, toxic int, quality int")
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = mixing.domain_model(docs, labels)
    assert model.seen.tolist() == [150, 0, 15]
    assert np.allclose(np.exp(model.shift), [2, 0, 2])
    p = {r.doc_id: r.p for r in mixing.memberships(docs, model, ["doc_id"]).collect()}
    assert all(p[i][1] == 0 for i in p) and sum(p[i][0] for i in range(300)) > 297
    assert sum(p[i][2] for i in range(300, 330)) > 29


def test_copies_follow_the_rates(spark):
    rates = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 5 / 2).alias("rate"))
    got = mixing.taken(rates).groupBy("rate").agg(F.avg("copies").alias("c"), F.min("copies").alias("lo"),
                                                  F.max("copies").alias("hi")).collect()
    for r in got:
        assert abs(r.c - r.rate) < 0.03 and r.lo >= int(r.rate) and r.hi <= int(r.rate) + 1


def test_mixed_documents_keep_their_columns(spark):
    docs = docs_table(spark, awkward_texts())
    model = mixing.domain_model(docs, some_labels(spark, awkward_texts()))
    out = mixing.mixed_documents(docs, model, {"clean": 1.0, "toxic": 0.2, "poor": 0.2}, full="clean", times=1.5)
    assert out.columns == docs.columns and out.schema == docs.schema
    copies = mixing.mix(docs, model, {"clean": 1.0, "toxic": 0.2, "poor": 0.2}, ["doc_id"], full="clean", times=1.5)
    assert out.count() == copies.agg(F.sum("copies")).first()[0]


def test_rates_are_those_of_projected_gradient_least_squares(spark):
    """The distributed fit against the descent in numpy, and against the
    optimum: no bound rate would grow and no free one moves the gaps."""
    rng = np.random.default_rng(7)
    p = rng.dirichlet([0.3, 0.1, 0.1], 3000)
    tokens = rng.integers(1, 500, 3000)
    members = spark.createDataFrame([(i, int(t), q.tolist()) for i, (t, q) in enumerate(zip(tokens, p, strict=True))],
                                    "doc_id long, n_tokens long, p array<double>")
    weights = {"a": 0.9, "b": 0.06, "c": 0.04}
    steps = mixing.fit_rates(members, ("a", "b", "c"), weights)
    out = members.withColumn("rate", mixing.rate_of(F.col("p"), steps)).orderBy("doc_id").toPandas()
    goal = np.array([0.9, 0.06, 0.04]) * tokens.sum()
    rate = np.ones(3000)
    moment = np.linalg.inv((p * tokens[:, None]).T @ p)  # the plain descent: W fixed, size 1
    for _ in range(5000):
        rate = np.maximum(0, rate - p @ (moment @ ((rate * tokens) @ p - goal)))
    assert np.allclose((rate * tokens) @ p, goal, rtol=1e-3)
    assert np.allclose((out.rate.to_numpy() * tokens) @ p, goal, rtol=1e-4 + 1e-9)
    assert (out.rate >= 0).all() and (out.rate == 0).any()


@pytest.mark.parametrize("op", ["toxicity", "quality", "mixing"])
def test_scores_do_not_depend_on_the_batch(op):
    """Each text alone, in batches and in another order scores bit for bit alike."""
    import pyarrow as pa

    from lakeledger.llm.common import text_bytes
    rng = np.random.default_rng(8)
    texts = [t or "" for _, t in awkward_texts()]
    labels = [int(i % 3 == 0) for i in range(len(texts))]
    if op == "toxicity":
        model = toxicity.fit([(t, y, "en") for t, y in zip(texts, labels, strict=True)])
        tables = model.tables()
        run = lambda some: model.score(tables, *text_bytes(pa.array(some, pa.string())))
    elif op == "quality":
        model = quality_classifier.fit([(t, y) for t, y in zip(texts, labels, strict=True)])
        use = quality_classifier.Compressors(model.good, model.bad)
        model.curve = (2.0, 0.1)  # these labels follow no text
        run = lambda some: model.score(use, [t.encode() for t in some])
    else:
        model = mixing.DomainModel().fit([(t, mixing.DOMAINS[i % 3]) for i, t in enumerate(texts)])
        run = lambda some: model.posterior(model.features(*text_bytes(pa.array(some, pa.string())))[0])
    alone = np.concatenate([run([t]) for t in texts])
    assert len(np.unique(alone)) > 5
    for size in (2, 7, 64, 500):
        order = rng.permutation(len(texts))
        got = np.concatenate([run([texts[i] for i in order[at:at + size]]) for at in range(0, len(order), size)])
        assert np.array_equal(got, alone[order])


def test_a_labelled_id_on_many_rows_is_one_training_text(spark):
    docs = spark.range(3000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
                                    F.lit("x").alias("label"), F.lit("y").alias("m"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([(7, 1), (7, 1)], "doc_id long, toxic int")
    rows = training.labelled_sample(docs, labels, F.col("toxic"), F.lit(True), [0, 1], extra=["lang", "m"])
    assert len(rows) == 1 and rows[0][1:] == (1, "en", "y")


def test_toxicity_learns_from_all_rows(spark, monkeypatch):
    """Texts of over 32 KB, classes over several shards: all are learnt from,
    and the result does not depend on how the rows lie."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 64)
    rng = np.random.default_rng(4)
    words = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(240):
        text = rng.choice(words, 5000 if i % 4 == 0 else 60).tolist()
        if i % 4 == 0:
            text[int(rng.integers(len(text)))] = "vile"
        rows.append((i, " ".join(text), "en" if i % 3 else "de"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, *_ in rows], "doc_id long, toxic int")
    assert min(len(t.encode()) for i, t, _ in rows if i % 4 == 0) > 32 << 10
    models = [toxicity.toxicity_model(docs.repartition(n), labels.repartition(n), F.lit(True)) for n in (2, 7)]
    assert np.array_equal(models[0].weights(), models[1].weights()) and models[0].scale == models[1].scale
    assert models[0].rows == 240 and models[0].thresholds == models[1].thresholds and set(models[0].thresholds) == {"de", "en"}
    new = spark.createDataFrame([(1, "word1 word2 vile word3", "en"), (2, "word1 word2 word3 word4", "en")], docs.schema)
    score = {r.doc_id: r.score for r in toxicity.toxicity(new, models[0]).collect()}
    assert score[1] > 0.5 > score[2]
