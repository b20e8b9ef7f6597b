"""The classifier on the held-out fold, and its defined cases."""

import math
import zlib

import numpy as np
from llm_fixtures import SF0001, SF001, documents  # noqa: F401
from pyspark.sql import functions as F

from caldim.llm import quality as Q
from caldim.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op3_quality_classifier"](spark, SF001).collect()}
    labels = spark.read.parquet(f"{SF001}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    right = [got[x.doc_id].predicted == x.quality for x in labels if got[x.doc_id].held_out]
    assert len(right) > 50 and np.mean(right) > 0.93


def test_only_text_is_scored(spark, documents):
    """Ids, source and language change nothing; repeated texts score alike."""
    rows = [(i, f"some words {i} here and there") for i in range(1, 60)] + [(i, "BAD!! WORDS!! " * (i % 7 + 1)) for i in range(100, 160)]
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i, _ in rows] + [(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = Q.train(documents(rows), labels)
    odd = [(1000, "BAD!! WORDS!!", "z"), (None, "some words here"), (1001, None), (1002, ""), (1002, ""), (1003, "x " * 200_000), (1004, "BAD!! WORDS!!")]
    got = Q.score(documents(odd).withColumn("score", F.lit("clash")), model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(odd) and by[1000].score == by[1004].score < 0.5 < by[None].score
    assert by[1001].score == by[1002].score and by[1000].source == "z"
    assert Q.score(documents(odd).limit(0), model).count() == 0


def test_nothing_to_train_on(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.score(documents([(1, "a b"), (2, None)]), Q.train(documents([(1, "a b")]), none)).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.5, 0), (0.5, 0)]


def test_features_are_plain():
    at, x = Q.features(np.frombuffer("Über Über  x\n".encode(), np.uint8))
    assert len(at) == len(x) and abs(np.linalg.norm(x) - np.sqrt(2)) < 1e-9
    assert len(Q.features(np.zeros(0, np.uint8))[0]) == 0


def test_same_model_again(spark):
    docs, labels = (spark.read.parquet(f"{SF0001}/{t}.parquet") for t in ("documents", "labels"))
    a, b = Q.train(docs, labels), Q.train(docs.repartition(7), labels)
    assert (a[0] == b[0]).all() and a[1] == b[1]


def plain_ftrl(rows, labels):
    """The updates one by one, over dictionaries: weights, and the intercept under None."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= Q.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * Q.L1) / ((Q.BETA + math.sqrt(n[i])) / Q.ALPHA + Q.L2)

    rng = np.random.default_rng(11)
    for _ in range(Q.EPOCHS):
        for k in rng.permutation(len(rows)):
            x = dict(rows[k]) | {None: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * x[i] for i in x)))))
            for i, v in x.items():
                g = (p - labels[k]) * v
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / Q.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_against_plain_updates(spark, documents):
    """Model and scores of the whole operator, by updates over dictionaries."""
    rng = np.random.default_rng(4)
    words = [f"w{k}" for k in range(60)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 30))) + ("!!" if k % 3 == 0 else "") for k in range(150)]
    rows = [(k, t) for k, t in enumerate(texts)]
    labels = spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(150)], "doc_id long, quality int, toxic int")
    model = Q.train(documents(rows), labels)
    order = [r.doc_id for r in spark.range(150).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    order = [k for k in order if zlib.crc32(str(k).encode()) % 4 != 2]

    def places(text):  # repeated places within a row add up
        out = {}
        at, x = Q.features(np.frombuffer(text.encode(), np.uint8))
        for i, v in zip(at.tolist(), x.tolist()):
            out[i] = out.get(i, 0.0) + v
        return out

    weights = plain_ftrl([places(texts[k]) for k in order], [int(k % 3 != 0) for k in order])
    got = np.nonzero(model[0])[0]
    assert {i for i, w in weights.items() if i is not None and abs(w) > 1e-6} == {int(i) for i in got if abs(model[0][i]) > 1e-6}
    assert all(abs(model[0][i] - weights[i]) < 1e-5 for i in got.tolist()) and abs(model[1] - weights[None]) < 1e-9
    for r in Q.score(documents(rows), model).collect():
        s = weights[None] + sum(weights.get(i, 0.0) * v for i, v in places(texts[r.doc_id]).items())
        assert abs(r.score - 1 / (1 + math.exp(-s))) < 1e-4


def test_repeated_ids_train_alike(spark, documents):
    """Of an id's texts the same one trains, however the rows lie."""
    rows = [(k, f"{'good words' if k % 2 else 'BAD!! 99'} {k} {j}") for k in range(80) for j in range(2)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(80)], "doc_id long, quality int, toxic int")
    models = [Q.train(documents(rows[::step]).repartition(parts), labels) for step, parts in ((1, 1), (-1, 3), (1, 7), (-1, 5))]
    assert all((m[0] == models[0][0]).all() and m[1] == models[0][1] for m in models)
