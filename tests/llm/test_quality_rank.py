import random

import numpy as np
from pyspark.sql import functions as F

from pulsewatch.llm import quality_rank as Q


def test_weights_minimise_the_pairwise_loss():
    r = np.random.default_rng(0)
    better, worse = r.integers(0, 4, (300, 1)), r.integers(0, 4, (300, 1))
    w = Q.pairwise_weights(better, worse, 4)

    def loss(v):
        return np.log1p(np.exp(v[worse].sum(1) - v[better].sum(1))).mean() + Q.PENALTY / 2 * (v ** 2).sum()

    assert all(loss(w) <= loss(w + 0.01 * r.standard_normal(4)) for _ in range(50))


def tables(spark):
    r = random.Random(1)
    good = lambda: ". ".join(" ".join(f"w{r.randrange(300)}" for _ in range(12)) for _ in range(5)) + "."
    bad = lambda: " ".join(f"W{r.randrange(9)}!!" for _ in range(50))
    rows = [(i, bad() if i % 6 == 0 else good(), 0 if i % 6 == 0 else 1) for i in range(900)]
    docs = [(i, t, "x") for i, t, _ in rows] + [(5000, None, "x"), (5001, "", "x"), (None, good(), "x"), (1, rows[1][1], "x")]
    return (spark.createDataFrame(docs, "doc_id long, text string, features string"),
            spark.createDataFrame([(i, q, 0) for i, _, q in rows if i % 2] + [(i, q, 0) for i, _, q in rows if not i % 2] + [(1, 1, 0), (7, None, 0), (None, 0, 0)],
                                  "doc_id long, quality int, toxic int"), {i: q for i, _, q in rows})


def test_held_out_texts_and_odd_rows(spark):
    docs, labels, want = tables(spark)
    got = Q.quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= x["score"] <= 1 for x in got)
    held = [x for x in got if x["held_out"] and x["doc_id"] in want]
    right = sum(x["predicted"] == want[x["doc_id"]] for x in held)
    assert right >= 0.97 * len(held)
    top = min(x["score"] for x in held if want[x["doc_id"]])
    assert sum(x["score"] < top for x in held if not want[x["doc_id"]]) >= 0.97 * sum(not want[x["doc_id"]] for x in held)
    by = [x["score"] for x in got if x["doc_id"] in (5000, 5001)]
    assert by[0] == by[1]


def test_without_labels_or_rows(spark):
    docs, labels, _ = tables(spark)
    assert len({x["score"] for x in Q.quality_scores(docs, labels.limit(0)).collect()}) == 1
    assert Q.quality_scores(docs.limit(0), labels).collect() == []


def test_every_labelled_text_and_every_pair_counts(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(240, len(Q.NAMES)))
    label = (x[:, 0] + 0.7 * r.normal(size=240) > 0).astype(int)
    train = spark.createDataFrame([(int(q), row) for q, row in zip(label, x.tolist())], "quality int, features array<double>")
    model = Q.Ranking(Q.learned_edges(train))
    assert all(abs(np.mean(x[:, k] >= e) - (1 - (i + 1) / Q.BINS)) < 0.02 for k, own in enumerate(model.edges) for i, e in enumerate(own))
    levels = Q.learn_weights(train, model)
    z, good, bad = model.bins(x), np.nonzero(label == 1)[0], np.nonzero(label == 0)[0]
    i, j = np.repeat(good, len(bad)), np.tile(bad, len(good))
    want = Q.pairwise_weights(z[i], z[j], len(model.weights))
    assert np.abs(model.weights - want).max() < 0.01 * np.abs(want).max()
    level = model.level(z)
    assert abs(Q.threshold(train, model, levels) - np.sort(level)[len(bad) - 1]) < 1e-5


def test_no_label_is_left_out_of_the_fit(spark):
    """More labelled texts of one label than any fixed number of them: all of them decide."""
    few = spark.range(40).selectExpr("0 as quality", "array_repeat(0.25D, 24) as features")
    many = spark.range(30_000).selectExpr("1 as quality", "array_repeat(if(id < 15000, 0.5D, 0.75D), 24) as features")
    train = few.unionByName(many)
    ids = train.withColumn("doc_id", F.monotonically_increasing_id())
    model = Q.fit(ids.select("doc_id", "features"), ids.select("doc_id", "quality"))
    assert sum(n.sum() for n in Q.Levels(train, model).n) == 30_040
    score = model.scores(np.array([[0.25] * 24, [0.5] * 24, [0.75] * 24]))
    assert score[0] < score[1] and score[0] < score[2] and score[0] >= Q.CUT - 1e-6
