"""Classification pipelines: label indexing, decision trees, perceptrons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame


def with_array_vector(df: DataFrame, values: str, output: str = "features") -> DataFrame:
    """An array column as an ML vector column."""
    return df.withColumn(output, array_to_vector(df[values].cast("array<double>")))


def with_label_index(df: DataFrame, label: str, output: str = "label_index") -> DataFrame:
    """Index labels by falling frequency, equal frequencies by value."""
    return StringIndexer(inputCol=label, outputCol=output, stringOrderType="frequencyDesc").fit(df).transform(df)


def with_label_back(df: DataFrame, index: str, labels: Sequence[str], output: str = "label") -> DataFrame:
    return IndexToString(inputCol=index, outputCol=output, labels=list(labels)).transform(df)


def category_indexer(df: DataFrame, features: str = "features", output: str = "indexed_features", max_categories: int = 4):
    """Re-index the vector slots with few distinct values; the others stay continuous."""
    return VectorIndexer(inputCol=features, outputCol=output, maxCategories=max_categories).fit(df)


def fit_decision_tree(df: DataFrame, label: str, features: str = "features", max_categories: int = 4, **params) -> PipelineModel:
    """Label indexing, slot indexing, the tree and the way back to labels (``predicted_label``) as one pipeline."""
    labels = StringIndexer(inputCol=label, outputCol="indexed_label").fit(df)
    slots = category_indexer(df, features, "indexed_features", max_categories)
    tree = DecisionTreeClassifier(labelCol="indexed_label", featuresCol="indexed_features", **params)
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels.labels)
    return Pipeline(stages=[labels, slots, tree, back]).fit(df)


def fit_perceptron(
    df: DataFrame,
    layers: Sequence[int],
    label: str = "label",
    features: str = "features",
    block_size: int = 128,
    seed: int = 1234,
    max_iter: int = 100,
):
    return MultilayerPerceptronClassifier(
        layers=list(layers), labelCol=label, featuresCol=features, blockSize=block_size, seed=seed, maxIter=max_iter
    ).fit(df)
