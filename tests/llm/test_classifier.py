import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from demandspark.llm import classifier
from tests.llm import samples


def corpus():
    rng = random.Random(0)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        text = samples.prose(i, rng.randint(30, 150))
        if not good:
            text = rng.choice([text.upper() + "!!!", (text.split()[0] + " ") * 80, " | ".join(text.split())])
        rows.append((i, text, "en", "s", len(text)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_sum_of_squares_identity():
    machine = classifier.Machine(2)
    machine.factors = np.random.default_rng(0).normal(0, 1, machine.factors.shape).astype(np.float64)
    machine.linear = np.random.default_rng(1).normal(0, 1, machine.linear.shape)
    index, value = np.array([3, 70, 900, classifier.BUCKETS + 4]), np.array([0.3, 1.0, -0.5, 0.5])
    pairs = sum(machine.factors[index[i]] @ machine.factors[index[j]] * value[i] * value[j] for i in range(4) for j in range(i))
    assert np.isclose(machine.margin(index, value), machine.bias[0] + machine.linear[index] @ value + pairs)


def test_model_bytes_round_trip():
    machine = classifier.Machine(3)
    loaded = classifier.Machine.load(machine.dump())
    assert (loaded.factors == machine.factors).all() and loaded.linear.shape == machine.linear.shape


def test_held_out_accuracy_and_contract(spark):
    rows, labels = corpus()
    docs = samples.documents(spark, rows + samples.awkward()[3:], clashing=True)
    marks = spark.createDataFrame(labels + [(None, 1, 0), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    got = [r for r in classifier.classify(docs, marks).collect()]
    assert len(got) == len(rows) + len(samples.awkward()[3:])
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out]
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    known = [r for r in held if r.doc_id in truth and r.doc_id > 9]
    assert len(known) > 50
    assert np.mean([r.predicted == truth[r.doc_id] for r in known]) > 0.95


def test_held_out_labels_and_identity_columns_do_not_count(spark):
    rows, labels = corpus()
    docs = samples.documents(spark, rows[:120])
    marks = spark.createDataFrame(labels[:120], "doc_id bigint, quality int, toxic int")
    flipped = marks.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None).cast("string"))
    first = samples.collected(classifier.classify(docs, marks))
    assert first == samples.collected(classifier.classify(other, flipped))


def test_without_labels_or_rows(spark):
    marks = spark.createDataFrame([], "doc_id bigint, quality int")
    assert classifier.classify(samples.documents(spark, []), marks).count() == 0
    scores = [r.score for r in classifier.classify(samples.documents(spark), marks).collect()]
    assert np.allclose(scores, 0.5, atol=0.01)
