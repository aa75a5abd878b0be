import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from basketlens.models import boosting, click
from basketlens.session import recorded

SCHEMA = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])


def table(spark, n, seed=1):
    """Labels that hang on some features; one feature is constant, one comes twice, one has few values."""
    rng = np.random.default_rng(seed)
    values = np.round(rng.normal(size=(n, 6)), 2)
    values[:, 1], values[:, 3], values[:, 4] = 1.0, rng.integers(0, 4, n), 2 * values[:, 0]
    label = (values[:, 0] * values[:, 2] + 0.4 * values[:, 3] + rng.normal(size=n) > 0.6).astype(float)
    return spark.createDataFrame([(float(y), Vectors.dense(x)) for y, x in zip(label, values)], SCHEMA)


def shape(model):
    """The trees' splits and predictions, rounded."""

    def walk(node):
        if node.numDescendants() == 0:
            return round(node.prediction(), 9)
        split = node.split()
        return split.featureIndex(), round(split.threshold(), 9), round(node.gain(), 9), walk(node.leftChild()), walk(node.rightChild())

    return [walk(tree._java_obj.rootNode() if hasattr(tree, "_java_obj") else tree.rootNode()) for tree in model.trees]


@pytest.mark.parametrize("n, size", [(2500, click.QUICK), (2500, click.GbtSize(max_iter=6, max_depth=3, max_bins=12, subsample=1.0, features="all")), (14000, click.QUICK)])
def test_trees_equal_those_of_spark(spark, monkeypatch, n, size):
    monkeypatch.setattr(boosting, "CHUNK", 300)
    rows = table(spark, n)  # of over 10,000 rows a sample gives the thresholds
    classifier = click.boosted_trees(size)
    with recorded() as paths:
        model = classifier.fit(rows)
    assert len(paths) == 1  # trained on stored bins, not by Spark's own trees
    plain = GBTClassifier._fit(classifier, rows)
    assert shape(model) == shape(plain)
    assert model.treeWeights == plain.treeWeights and model.numFeatures == plain.numFeatures
    assert model.featureImportances.toArray() == pytest.approx(plain.featureImportances.toArray(), abs=1e-9)
    scores = [[r[0].toArray().tolist() for r in m.transform(rows).select("rawPrediction").collect()] for m in (model, plain)]
    assert np.allclose(*scores)


def test_other_settings_go_to_spark(spark):
    rows = table(spark, 200)
    with recorded() as paths:
        click.boosted_trees(click.GbtSize(max_iter=2, max_depth=2, max_bins=8)).fit(rows)
    assert not paths


def test_cuts_of_values_counted_by_weight():
    values = np.array([0.0] * 50 + [1.0] * 5 + [-2.0] * 30 + [3.0, 4.0, 5.0] * 5)
    assert boosting._cuts(values, len(values), 9).tolist() == [-1.0, 0.5, 2.0, 3.5, 4.5]
    assert len(boosting._cuts(np.arange(1000.0), 1000, 31)) == 31
    assert boosting._cuts(np.zeros(9), 9, 31).tolist() == []


@pytest.mark.parametrize("label", [2.0, None])
def test_labels_of_other_classes_are_refused(spark, label):
    rows = spark.createDataFrame([(0.0, Vectors.dense(1.0)), (label, Vectors.dense(2.0))], SCHEMA)
    with pytest.raises(ValueError):
        click.boosted_trees(click.QUICK).fit(rows)
