"""The ordinal model: its gradient by likelihood, order of thresholds, held-out accuracy."""

import random

import numpy as np
import pytest

from sediment.llm import quality

SCHEMA = "doc_id long, text string, grade string, doc string, _hash string"


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(1)
    rows, grades = [], []
    for _ in range(600):
        good, bad = rng.random(2)
        rows.append((quality.BUCKETS // 2 + np.array([1, 2]), np.array([good, bad])))  # shapes
        score = 6 * good - 6 * bad + rng.logistic()
        grades.append(int(score > -2) + int(score > 2))
    model = quality.fit(rows, np.array(grades), steps=600)
    up, down = model.weights[quality.BUCKETS // 2 + 1 :][:2]
    assert up > 2 and down < -2 and (np.diff(model.thresholds) > 0).all()
    chance = quality.logistic(np.array([model.weights[b] @ v for b, v in rows])[:, None] - model.thresholds)
    assert np.mean(np.round(chance.sum(axis=1)) == grades) > 0.6


def labelled():
    draw = random.Random(3)
    good, bad, toxic = [f"g{i}" for i in range(200)], [f"B{i}!!" for i in range(200)], ["vile", "scum", "idiots"]
    rows, labels = [], []
    for i in range(900):
        grade = i % 3
        words = draw.choices(bad if grade == 1 else good, k=40)
        if grade == 0:
            words[draw.randrange(40)] = draw.choice(toxic)
        rows.append((i, " ".join(words), "x", "y", "z"))
        labels.append((i, int(grade != 1), int(grade == 0)))
    return rows, labels


def test_learned_grades_hold_on_other_documents(spark):
    rows, labels = labelled()
    frame = spark.createDataFrame(rows, SCHEMA)
    marked = spark.createDataFrame([*labels, (0, None, None), (None, 1, 0), (1, 1, 0), (5000, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.learn(frame, marked)
    again = quality.learn(frame.repartition(5), marked)
    assert np.array_equal(model.weights, again.weights)
    found = quality.grade(frame, model).withColumn("out", quality.held_out(quality.F.col("_id"))).where("out").collect()
    assert np.mean([r["selected"] == (r["_id"] % 3 == 2) for r in found]) > 0.9
    assert np.mean([(r["p_clean"] >= 0.5) == (r["_id"] % 3 != 0) for r in found]) > 0.9
    assert all(r["p_good"] <= r["p_clean"] and r["expected_grade"] == pytest.approx(r["p_good"] + r["p_clean"]) for r in found)


def test_edges(spark):
    rows, labels = labelled()
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    odd = [(None, "g1 g2", "", "", ""), (1000, None, "", "", ""), (1001, "", "", "", ""), (1002, "g1 " * 50_000, "", "", ""), (7, rows[7][1], "", "", "")]
    frame = spark.createDataFrame(rows + odd, SCHEMA)
    model = quality.learn(frame, marked, sample=50)
    found = quality.grade(frame, model).collect()
    assert len(found) == len(rows) + 5 and all(0 <= r["p_good"] <= r["p_clean"] <= 1 for r in found)
    assert quality.grade(frame.limit(0), model).collect() == []
    none = quality.learn(frame, marked.limit(0))
    assert quality.grade(frame.where("doc_id = 1000"), none).count() == 1


def test_features():
    buckets, values = quality.features(b"One one TWO!! 12")
    assert (values == 1).sum() == 3 and len(set(buckets[:3])) == 3
    assert quality.features(None)[0].size == quality.features(b"")[0].size == 0
