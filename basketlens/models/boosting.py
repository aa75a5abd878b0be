"""Boosted trees on binned rows that stay in files, for tables whose rows don't fit the memory as objects.

The trees are those of ``GBTClassifier``: the same bins, gains and residuals, and
the same model. Rows are binned once, a byte a feature, and stored in chunks by
feature. A level of a tree is one pass: each task adds up the residuals of its
rows by node, feature and bin, after it has placed them in the trees so far.
Nothing is kept of a row between the passes, so memory doesn't grow with the rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.session import forget, materialise, short_splits

#: Rows of a chunk, chunks of a file and of a read.
CHUNK, FILE_CHUNKS, READ = 1 << 16, 24, 4
#: Rows that thresholds are taken from, at least; what a byte holds; features whose sums stay small.
SAMPLE, BINS, DEPTH, FEATURES = 10_000, 256, 7, 256
EPSILON = np.finfo(float).eps

# Workers need not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Node:
    """A node with the number, sum and sum of squares of its residuals; a leaf without ``feature``."""

    n: float
    total: float
    squares: float
    gain: float = -1.0
    feature: int = -1
    bin: int = -1
    left: Node | None = None
    right: Node | None = None

    @property
    def mean(self) -> float:
        return self.total / self.n if self.n else 0.0

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.n) / self.n if self.n else 0.0


class BinnedTrees(GBTClassifier):
    """``GBTClassifier`` for two classes, all rows and all features by tree; other settings go to Spark's own."""

    def _fit(self, dataset: DataFrame) -> GBTClassificationModel:
        first = dataset.select(self.getFeaturesCol()).first()
        width = first[0].size if first else 0
        plain = self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() in ("auto", "all")
        plain &= self.getMinWeightFractionPerNode() == 0 and not any(map(self.isDefined, (self.weightCol, self.validationIndicatorCol)))
        if not (plain and 0 < width <= FEATURES and self.getMaxBins() <= BINS and self.getMaxDepth() <= DEPTH):
            return super()._fit(dataset)
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("label"), vector_to_array(self.getFeaturesCol()).alias("values"))
        total, known = rows.agg(F.count("*"), F.count_if(F.col("label").isin(0.0, 1.0))).first()
        if known < total:
            raise ValueError("labels must be 0 or 1")
        cuts = self._thresholds(rows, total)
        chunks = materialise(rows.mapInArrow(_binned(cuts), "label binary, bins binary"), "click-bins", file_rows=FILE_CHUNKS)
        trees: list[tuple[Node, float]] = []
        with short_splits(dataset.sparkSession, READ):
            for step in [1.0, *[self.getStepSize()] * (self.getMaxIter() - 1)]:
                trees.append((self._tree(chunks, trees, cuts), step))
        forget(chunks)
        return self._copyValues(_model(self, trees, cuts))

    def _thresholds(self, rows: DataFrame, total: int) -> list[np.ndarray]:
        """Cuts between the bins of each feature, from all rows or a sample of them."""
        bins = min(self.getMaxBins(), total)
        share = min(1.0, max(self.getMaxBins() ** 2, SAMPLE) / total)
        picked = rows if share == 1.0 else self._sample(rows, share)
        values = np.array([r[0] for r in picked.select("values").collect()], float)  # some 10,000 rows
        return [_cuts(column, total * share, bins - 1) for column in values.T]

    def _sample(self, rows: DataFrame, share: float) -> DataFrame:
        """The rows that Spark's trees take their thresholds from."""
        session = rows.sparkSession
        seed = session._jvm.org.apache.spark.util.random.XORShiftRandom(self.getSeed()).nextInt()
        picked = rows._jdf.toJavaRDD().sample(False, share, seed)
        return DataFrame(session._jsparkSession.createDataFrame(picked, rows._jdf.schema()), session)

    def _tree(self, chunks: DataFrame, trees: list, cuts: list[np.ndarray]) -> Node:
        width = max(map(len, cuts)) + 1
        before, root = [(_levels(tree), step) for tree, step in trees], None
        grown: list[Node] = []
        for depth in range(self.getMaxDepth()):
            above = _levels(root) if root else []
            sums = _added(chunks, before, above, len(cuts), width, 1 << depth)
            if not root:
                n, total = sums[0][0, 0].sum(1)
                root = Node(n, total, sums[1][0])
                grown = [root]
            fresh: list[Node] = []
            for place, node in enumerate(_row(root, depth)):
                if node is not None and any(node is g for g in grown):
                    node.squares = sums[1][place]
                    fresh += self._split(node, sums[0][place], sums[2][place], cuts)
            grown = fresh
            if not grown:
                break
        return _pruned(root)

    def _split(self, node: Node, sums: np.ndarray, squares: np.ndarray, cuts: list[np.ndarray]) -> list[Node]:
        """Give ``node`` its best split; the children that may be split in turn."""
        best = None
        for feature, cut in enumerate(cuts):
            if not len(cut):
                continue
            added = np.stack([*sums[feature], squares[feature]]).cumsum(1)
            n, total, square = added[:, : len(cut)]
            n_right, total_right, square_right = added[:, -1:] - added[:, : len(cut)]
            with np.errstate(divide="ignore", invalid="ignore"):
                left, right = (square - total * total / n) / n, (square_right - total_right * total_right / n_right) / n_right
                gain = node.impurity - n / node.n * left - n_right / node.n * right
            least = self.getMinInstancesPerNode()
            gain = np.where((n >= least) & (n_right >= least) & (gain >= self.getMinInfoGain()), gain, -np.inf)
            at = int(gain.argmax())
            if best is None or gain[at] > best[0]:
                best = gain[at], feature, at, (n[at], total[at], square[at]), (n_right[at], total_right[at], square_right[at])
        if best is None or not best[0] > 0:
            return []
        node.gain, node.feature, node.bin = float(best[0]), best[1], best[2]
        node.left, node.right = Node(*map(float, best[3])), Node(*map(float, best[4]))
        return [child for child in (node.left, node.right) if abs(child.impurity) >= EPSILON]


def _cuts(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` cuts that leave about as many of ``values`` in each bin; zeros count as what others leave of ``expected``."""
    found, held = np.unique(values[values != 0], return_counts=True)
    zeros, counts = expected - held.sum(), held.astype(float)
    if zeros > EPSILON * len(values) * 100 and len(found):
        at = np.searchsorted(found, 0.0)
        found, counts = np.insert(found, at, 0.0), np.insert(counts, at, zeros)
    middles = (found[:-1] + found[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = expected / (most + 1)
    cuts, target, passed = [], stride, np.cumsum(counts)
    for at in range(1, len(found)):
        if abs(passed[at - 1] - target) < abs(passed[at] - target):
            cuts.append(middles[at - 1])
            target += stride
    return np.array(cuts)


def _binned(cuts: list[np.ndarray]) -> Callable:
    """Rows as chunks: a byte a label, and bytes of bins feature by feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(most: int) -> Iterator[pa.RecordBatch]:
            nonlocal waiting
            while waiting and sum(len(labels) for labels, _ in waiting) >= most:
                labels, bins = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting], 1)
                waiting = [(labels[CHUNK:], bins[:, CHUNK:])] if len(labels) > CHUNK else []
                yield pa.record_batch([pa.array([labels[:CHUNK].tobytes()]), pa.array([np.ascontiguousarray(bins[:, :CHUNK]).tobytes()])], names=["label", "bins"])

        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if batch.num_rows:
                values = batch.column("values").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                bins = np.stack([np.searchsorted(cut, column).astype(np.uint8) for cut, column in zip(cuts, values.T)])
                waiting.append((batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8), bins))
            yield from chunk(CHUNK)
        yield from chunk(1)

    return run


def _row(root: Node, depth: int) -> list[Node | None]:
    """The nodes of a level, by their place."""
    nodes: list[Node | None] = [root]
    for _ in range(depth):
        nodes = [child for node in nodes for child in ((node.left, node.right) if node else (None, None))]
    return nodes


def _levels(root: Node) -> list:
    """(place, feature, bin) of the splits of each level, then the means of the leaves, by the place where they end."""
    levels, depth = [], 0
    nodes: list[Node | None] = [root]
    while any(node is not None and node.feature >= 0 for node in nodes):
        levels.append([(place, node.feature, node.bin) for place, node in enumerate(nodes) if node is not None and node.feature >= 0])
        # A leaf stays in the left place below it.
        nodes = [c for node in nodes for c in ((None, None) if node is None else (node.left, node.right) if node.feature >= 0 else (node, None))]
        depth += 1
    return [*levels, np.array([node.mean if node else 0.0 for node in nodes])]


def _placed(bins: np.ndarray, levels: list) -> np.ndarray:
    """The place of each row below the splits of ``levels``."""
    place = np.zeros(bins.shape[1], np.uint8)
    for level in levels:
        right = np.zeros(bins.shape[1], bool)
        for at, feature, last in level:
            right |= (place == at) & (bins[feature] > last)
        place = place * np.uint8(2) + right
    return place


def _added(chunks: DataFrame, before: list, above: list, features: int, width: int, nodes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number, sum) of residuals by node, feature and bin, their squares by node, and by node, feature and bin."""
    shape = (nodes, features, 3, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, any_rows = np.zeros(shape), False
        for batch in batches:
            for labels, stored in zip(batch.column("label"), batch.column("bins")):
                bins = np.frombuffer(stored.as_buffer(), np.uint8).reshape(features, -1)
                sign = np.frombuffer(labels.as_buffer(), np.uint8) * 2.0 - 1.0
                rest = sign
                if before:
                    margin = np.zeros(len(sign))
                    for levels, step in before:
                        margin += (step * levels[-1])[_placed(bins, levels[:-1])]
                    rest = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
                base = _placed(bins, above[:-1]).astype(np.int64) * width
                square, any_rows = rest * rest, True
                for feature in range(features):
                    key = base + bins[feature]
                    for at, weights in enumerate((None, rest, square)):
                        sums[:, feature, at] += np.bincount(key, weights, nodes * width).reshape(nodes, width)
        if any_rows:
            yield pa.record_batch([pa.array([sums.tobytes()])], names=["sums"])

    found = np.zeros(shape)
    for row in chunks.mapInArrow(run, "sums binary").collect():  # a row a task
        found += np.frombuffer(row[0]).reshape(shape)
    return found[:, :, :2], found[:, 0, 2].sum(1), found[:, :, 2]


def _pruned(node: Node) -> Node:
    """Splits whose two leaves predict the same become leaves."""
    if node.feature >= 0:
        left, right = _pruned(node.left), _pruned(node.right)
        if left.feature < 0 and right.feature < 0 and left.mean == right.mean:
            node.feature, node.left, node.right = -1, None, None
    return node


def _model(classifier: GBTClassifier, trees: list[tuple[Node, float]], cuts: list[np.ndarray]) -> GBTClassificationModel:
    """Spark's model of the trees."""
    from pyspark import SparkContext

    context = SparkContext._active_spark_context
    jvm, gateway = context._jvm, context._gateway
    ml, regression = jvm.org.apache.spark.ml, jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel

    def doubles(values: list[float]):
        array = gateway.new_array(gateway.jvm.double, len(values))
        for at, value in enumerate(values):
            array[at] = float(value)
        return array

    def build(node: Node):
        held = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles([node.n, node.total, node.squares]), int(node.n))
        if node.feature < 0:
            return ml.tree.LeafNode(node.mean, node.impurity, held)
        split = ml.tree.ContinuousSplit(node.feature, float(cuts[node.feature][node.bin]))
        return ml.tree.InternalNode(node.mean, node.impurity, node.gain, build(node.left), build(node.right), split, held)

    array = gateway.new_array(regression, len(trees))
    for at, (tree, _) in enumerate(trees):
        array[at] = regression(f"{classifier.uid}_tree_{at}", build(tree), len(cuts))
    return GBTClassificationModel(ml.classification.GBTClassificationModel(classifier.uid, array, doubles([step for _, step in trees]), len(cuts), 2))
