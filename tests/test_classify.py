import random

import pytest
from pyspark.ml.functions import vector_to_array

from millrace.operators import classify, stats, tables
from millrace.sources.generated import literal_rows

# Income, age, weight, label of twelve people.
PEOPLE = [
    (30000, 35, 120, 1),
    (20000, 30, 100, 0),
    (40000, 42, 80, 1),
    (32000, 37, 60, 0),
    (42000, 37, 99, 1),
    (22000, 47, 70, 1),
    (32000, 57, 60, 1),
    (52000, 67, 30, 0),
    (82000, 37, 40, 0),
    (72000, 47, 80, 1),
    (62000, 57, 90, 0),
    (32000, 17, 70, 0),
]


def test_decision_tree_pipeline(spark):
    df = literal_rows(spark, PEOPLE, "income int, age int, weight int, label int")
    df = tables.with_vectors(df, {"features": ["income", "age", "weight"]})
    model = classify.fit_decision_tree(df, "label")
    out = model.transform(df)
    assert {"indexed_label", "indexed_features", "prediction", "predicted_label"} <= set(out.columns)
    score = stats.accuracy(out, "label", "predicted_label").first()
    assert score["rows"] == 12 and score["accuracy"] >= 0.9


def test_perceptron_learns_blobs(spark):
    rng = random.Random(1)
    rows = [(i, [c + rng.gauss(0, 0.1), 2.0 * (c == 1), rng.random(), 0.0], float(c)) for i in range(150) for c in [i % 3]]
    df = classify.with_array_vector(spark.createDataFrame(rows, "id int, values array<double>, label double"), "values")
    parts = tables.split_frames(df, "id", {"train": 0.6, "test": 0.4}, seed=1234)
    model = classify.fit_perceptron(parts["train"], [4, 5, 4, 3])
    assert stats.accuracy(model.transform(parts["test"]), "label", "prediction").first()["accuracy"] > 0.8


def test_label_index_by_frequency_then_value(spark):
    df = spark.createDataFrame([(v,) for v in "bbaaccc"], "v string")
    indexed = classify.with_label_index(df, "v")
    assert {(r.v, r.label_index) for r in indexed.collect()} == {("c", 0.0), ("a", 1.0), ("b", 2.0)}
    back = classify.with_label_back(indexed, "label_index", ["c", "a", "b"], "w")
    assert back.where("v <> w").count() == 0


def test_only_slots_with_few_values_are_indexed(spark):
    rows = [(float(i), 5.0 * (i % 4)) for i in range(20)]
    df = tables.with_vectors(spark.createDataFrame(rows, "many double, few double"), {"features": ["many", "few"]})
    out = classify.category_indexer(df).transform(df).select("many", "few", vector_to_array("indexed_features").alias("v"))
    assert all(r.v[0] == r.many and r.v[1] == r.few / 5 for r in out.collect())


def test_accuracy_of_agreement(spark):
    row = stats.accuracy(spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "a int, b int"), "a", "b").first()
    assert tuple(row) == (4, 3, pytest.approx(0.75))
