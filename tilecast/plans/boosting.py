"""Gradient-boosted regression trees over binned rows.

The trees are those of Spark ML's GBTRegressor for squared error: the same bins, gains, leaf values and
weights. Only the way to the histograms differs. A feature is a byte, rows lie in blocks of columns, and
one job per tree level sums the histograms of a block with numpy; of two sister nodes the smaller one is
counted, the other is what it leaves of their parent. The driver sees one histogram per task and job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.session import delete_tables, materialize, recorded, send_package

#: Rows in a block, and trees after which what is left of all rows is kept anew.
BLOCK = 65_536
KEEP = 4
#: Combinations of bins that are counted at once.
JOINT = 4096
_NAMES = ["bins", "rest"]
_SCHEMA = "bins binary, rest binary"
_EPSILON = 2.0**-52
#: Gains nearer to each other than this share are equal: the first feature is taken.
_TIE = 1e-11


@dataclass
class Node:
    """A leaf, or a split: ``left`` holds the bins that go left, ``threshold`` the largest such value."""

    value: float
    count: float = 0.0
    square: float = 0.0
    histogram: np.ndarray | None = None
    feature: int = -1
    gain: float = 0.0
    left: np.ndarray | None = None
    threshold: float | None = None
    children: tuple[Node, Node] | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.children is None else [x for c in self.children for x in c.leaves()]

    def splits(self) -> Iterator[Node]:
        if self.children is not None:
            yield self
            for child in self.children:
                yield from child.splits()


@dataclass
class Tree:
    root: Node
    weight: float
    leaves: list[Node] = field(default_factory=list)

    def leaf_of(self, goes_left, n: int) -> np.ndarray:
        """The number of each row's leaf; ``goes_left`` tells for a split which rows go left."""
        self.leaves = self.root.leaves()
        number = {id(leaf): i for i, leaf in enumerate(self.leaves)}
        splits = list(self.root.splits())
        if len(splits) <= 8:  # one bit for each split's answer, then a look into a table of all answers
            answers = np.zeros(n, np.uint8)
            for bit, split in enumerate(splits):
                answers |= goes_left(split).view(np.uint8) << np.uint8(bit)
            place = {id(split): bit for bit, split in enumerate(splits)}
            ends = []
            for code in range(1 << len(splits)):
                node = self.root
                while node.children is not None:
                    node = node.children[1 - (code >> place[id(node)] & 1)]
                ends.append(number[id(node)])
            return np.array(ends, np.uint8).take(answers)
        kind = np.uint8 if len(number) <= 256 else np.int32

        def visit(node: Node):
            if node.children is None:
                return kind(number[id(node)])
            return np.where(goes_left(node), *[visit(c) for c in node.children])

        return np.broadcast_to(visit(self.root), n)

    def predict(self, goes_left, n: int) -> np.ndarray:
        numbers = self.leaf_of(goes_left, n)
        return np.array([leaf.value for leaf in self.leaves]).take(numbers)


def _levels(dataset: DataFrame, column: str) -> dict[int, int]:
    """The number of levels of each categorical slot of the feature vector."""
    attributes = dataset.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    levels = {a["idx"]: 2 for a in attributes.get("binary", [])}
    for a in attributes.get("nominal", []):
        levels[a["idx"]] = len(a["vals"]) if "vals" in a else a["num_vals"]
    return levels


def thresholds_of(values: np.ndarray, n_splits: int) -> np.ndarray:
    """Borders between the distinct values, at most ``n_splits`` of about equally many rows each."""
    found, counts = np.unique(values, return_counts=True)
    middle = (found[:-1] + found[1:]) / 2
    if len(middle) <= n_splits:
        return middle
    stride = len(values) / (n_splits + 1)
    target, seen, borders = stride, counts[0], []
    for i in range(1, len(found)):
        before, seen = seen, seen + counts[i]
        if abs(before - target) < abs(seen - target):
            borders.append(middle[i - 1])
            target += stride
    return np.array(borders)


def _to_blocks(thresholds: list[np.ndarray | None], kind: type):
    """Rows of a feature array and a label as blocks: columns of bins, and what is left to explain."""
    d = len(thresholds)

    def block(parts) -> pa.RecordBatch:
        x, y = (np.concatenate(p) for p in zip(*parts))
        bins = np.empty((d, len(y)), kind)
        for j, borders in enumerate(thresholds):
            bins[j] = x[:, j] if borders is None else np.searchsorted(borders, x[:, j])
        return pa.RecordBatch.from_arrays([pa.array([bins.tobytes()]), pa.array([y.tobytes()])], _NAMES)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            if not (np.isfinite(y).all() and np.isfinite(x).all()):
                raise ValueError("labels and features must be finite")
            if len(y):
                parts.append((x, y))
                held += len(y)
            if held >= BLOCK:
                yield block(parts)
                parts, held = [], 0
        if parts:
            yield block(parts)

    return run


def _read(block: tuple[bytes, bytes], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Bins by feature, and what is left of the labels."""
    rest = np.frombuffer(block[1])
    return np.frombuffer(block[0], kind).reshape(-1, len(rest)), rest


def _of_bins(bins: np.ndarray):
    def goes_left(node: Node) -> np.ndarray:
        if node.threshold is not None:
            return bins[node.feature] < int(node.left.sum())
        return node.left[bins[node.feature]]

    return goes_left


def _left_over(bins: np.ndarray, rest: np.ndarray, trees: list[Tree]) -> np.ndarray:
    """What is left of ``rest`` after the trees."""
    rest = rest.copy()
    for tree in trees:
        rest -= tree.weight * tree.predict(_of_bins(bins), len(rest))
    return rest


def _advance(trees: list[Tree], kind: type):
    return lambda block: (block[0], _left_over(*_read(block, kind), trees).tobytes())


def _groups(sizes: list[int], most: int = JOINT) -> list[list[int]]:
    """Neighbouring features whose bins together have at most ``most`` combinations."""
    groups, product = [], most + 1
    for j, size in enumerate(sizes):
        if product * size > most:
            groups.append([])
            product = 1
        groups[-1].append(j)
        product *= size
    return groups


def _histograms(trees: list[Tree], tree: Tree | None, wanted: list[int], first: bool, sizes: list[int], kind: type):
    """Counts and sums of what is left, per wanted leaf of ``tree``, feature and bin; and sums of squares.

    Several features are counted at once by the combinations of their bins, which are then summed up.
    """
    groups = _groups(sizes)
    width = max(sizes)

    def run(blocks):
        joint, squares = None, np.zeros(len(wanted))
        for bins, rest in (_read(block, kind) for block in blocks):
            rest = rest if first else 2.0 * _left_over(bins, rest, trees)
            if joint is None:
                joint = [[np.zeros((2, int(np.prod([sizes[j] for j in g])))) for g in groups] for _ in wanted]
            numbers = None if tree is None else tree.leaf_of(_of_bins(bins), len(rest))
            for k, leaf in enumerate(wanted):
                rows = None if numbers is None else np.flatnonzero(numbers == leaf)
                values = rest if rows is None else rest.take(rows)
                squares[k] += values @ values
                for g, sums in zip(groups, joint[k]):
                    code = bins[g[0]].astype(np.uint16)
                    for j in g[1:]:
                        code = code * np.uint16(sizes[j]) + bins[j]
                    code = (code if rows is None else code.take(rows)).astype(np.intp)
                    sums[0] += np.bincount(code, minlength=sums.shape[1])
                    sums[1] += np.bincount(code, values, sums.shape[1])
        if joint is not None:
            total = np.zeros((len(wanted), len(sizes), 2, width))
            for k in range(len(wanted)):
                for g, sums in zip(groups, joint[k]):
                    cube = sums.reshape(2, *[sizes[j] for j in g])
                    for at, j in enumerate(g):
                        others = tuple(a + 1 for a in range(len(g)) if a != at)
                        total[k, j, :, : sizes[j]] = cube.sum(axis=others)
            yield total, squares

    return run


class OnBins(Estimator):
    """Trees on the ``features`` vector, each slot cut into ``max_bins`` bins at most.

    Numbers are split at one of at most ``max_bins - 1`` borders between values of a sample of
    max(10,000, max_bins²) rows; slots with nominal or binary attributes by sets of levels.
    """

    def __init__(self, n_trees, depth, seed, label, prediction, max_bins, features):
        super().__init__()
        self.n_trees, self.depth, self.seed = n_trees, depth, seed
        self.label, self.prediction, self.max_bins, self.features = label, prediction, max_bins, features

    def _binned(self, dataset: DataFrame) -> tuple[DataFrame, list[np.ndarray | None], list[int], type]:
        """Rows of features and label; the borders of each feature, its number of bins, and a bin's type."""
        send_package(dataset.sparkSession)
        levels = _levels(dataset, self.features)
        rows = dataset.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y"))
        n = rows.count()
        if n == 0:
            raise ValueError("trees need rows")
        max_bins = min(self.max_bins, n)
        if max(levels.values(), default=0) > max_bins:
            raise ValueError(f"a column has {max(levels.values())} levels, more than maxBins {max_bins}")
        borders = self._borders(rows, n, levels, max_bins)
        sizes = [levels[j] if b is None else len(b) + 1 for j, b in enumerate(borders)]
        return rows, borders, sizes, np.uint8 if max(sizes) <= 256 else np.uint16

    def _borders(self, rows, n, levels, max_bins) -> list[np.ndarray | None]:
        wanted = max(max_bins * max_bins, 10_000)
        sample = rows.select("x") if wanted >= n else rows.select("x").sample(wanted / n, self.seed)
        x = np.array([r.x for r in sample.collect()], float)
        if not len(x):
            x = np.array([rows.first().x], float)
        return [None if j in levels else thresholds_of(x[:, j], max_bins - 1) for j in range(x.shape[1])]


class BoostedTrees(OnBins):
    """``n_trees`` trees of ``depth`` levels on squared error, each of the later ones shrunk by ``rate``."""

    def __init__(self, n_trees, depth, rate, seed, label, prediction, max_bins=32, features="features"):
        super().__init__(n_trees, depth, seed, label, prediction, max_bins, features)
        self.rate = rate

    def _fit(self, dataset: DataFrame) -> BoostedTreesModel:
        rows, borders, sizes, kind = self._binned(dataset)
        with recorded() as written:
            blocks = materialize(rows.mapInArrow(_to_blocks(borders, kind), _SCHEMA), "blocks")
            trees = self._grow(blocks, borders, sizes, kind)
            delete_tables(dataset.sparkSession, written)
        return BoostedTreesModel(trees, len(borders), self.features, self.prediction)

    def _grow(self, blocks, borders, sizes, kind) -> list[Tree]:
        trees, pending = [], []
        # pickled blocks go to the Python workers as they are held, without a turn through rows and Arrow
        blocks = blocks.rdd.map(lambda r: (bytes(r[0]), bytes(r[1]))).persist(StorageLevel.MEMORY_AND_DISK)
        for t in range(self.n_trees):
            if len(pending) == KEEP:
                old, blocks = blocks, blocks.map(_advance(pending, kind)).persist(StorageLevel.MEMORY_AND_DISK)
                blocks.count()
                old.unpersist()
                pending = []

            def sums(tree, wanted, pending=pending, blocks=blocks, first=t == 0):
                found = blocks.mapPartitions(_histograms(pending, tree, wanted, first, sizes, kind)).collect()
                return sum(r[0] for r in found), sum(r[1] for r in found)

            tree = self._tree(sums, borders, 1.0 if t == 0 else self.rate)
            for node in tree.root.splits():
                node.histogram = None
            for node in tree.root.leaves():
                node.histogram = None
            trees.append(tree)
            pending.append(tree)
        blocks.unpersist()
        return trees

    def _tree(self, sums, borders, weight) -> Tree:
        total, squares = sums(None, [0])
        tree = Tree(_node(total[0], squares[0]), weight)
        open_nodes = [tree.root]
        for level in range(self.depth):
            split = [node for node in open_nodes if _split(node, borders)]
            if level == self.depth - 1 or not split:
                break
            # the smaller of each two sisters is counted
            numbers = {id(leaf): i for i, leaf in enumerate(tree.root.leaves())}
            smaller = [min((0, 1), key=lambda c, node=node: node.children[c].count) for node in split]
            total, squares = sums(tree, [numbers[id(node.children[c])] for node, c in zip(split, smaller)])
            open_nodes = []
            for k, (node, c) in enumerate(zip(split, smaller)):
                counted, other = node.children[c], node.children[1 - c]
                counted.histogram, counted.square = total[k], squares[k]
                other.histogram, other.square = node.histogram - total[k], node.square - squares[k]
                other.histogram[:, 1][other.histogram[:, 0] == 0] = 0.0
                open_nodes += node.children
        return tree


def _node(histogram: np.ndarray, square: float) -> Node:
    count, total = histogram[0].sum(axis=1)
    return Node(total / count, count, square, histogram)


def _split(node: Node, borders: list[np.ndarray | None]) -> bool:
    """Split the node where that explains most, if anywhere."""
    count = node.count
    variance = node.square / count - node.value**2
    if variance < _EPSILON:
        return False
    total = node.value * count
    best = None
    for j, border in enumerate(borders):
        counts, values = node.histogram[j]
        order = np.arange(len(counts))
        if border is None:
            means = np.divide(values, counts, out=np.full(len(counts), np.inf), where=counts > 0)
            order = np.argsort(means, kind="stable")
        c, s = np.cumsum(counts[order])[:-1], np.cumsum(values[order])[:-1]
        valid = (c > 0) & (c < count)
        if not valid.any():
            continue
        c, s = c[valid], s[valid]
        gains = s * s / c + (total - s) ** 2 / (count - c) - total * total / count
        i = int(np.argmax(gains >= gains.max() * (1 - _TIE)))
        if gains[i] > _TIE * node.square and (best is None or gains[i] > best[0] * (1 + _TIE)):
            left = np.zeros(len(counts), bool)
            left[order[: int(np.flatnonzero(valid)[i]) + 1]] = True
            best = gains[i], j, left, c[i], s[i]
    if best is None:
        return False
    node.gain, node.feature, node.left, c, s = best
    border = borders[node.feature]
    node.threshold = None if border is None else float(border[int(node.left.sum()) - 1])
    node.children = Node(s / c, c), Node((total - s) / (count - c), count - c)
    return True


class BoostedTreesModel(Model):
    """Fitted trees; rows are scored where they lie."""

    def __init__(self, trees: list[Tree], n_features: int, features: str, prediction: str):
        super().__init__()
        self.trees, self.n_features = trees, n_features
        self.features, self.prediction = features, prediction

    @property
    def featureImportances(self) -> DenseVector:
        """What the splits of each feature explain, as shares of all."""
        total = np.zeros(self.n_features)
        for tree in self.trees:
            for node in tree.root.splits():
                total[node.feature] += node.gain
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, d = self.trees, self.n_features

        def score(x: pa.Array) -> pa.Array:
            columns = np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d).T)

            def goes_left(node: Node) -> np.ndarray:
                values = columns[node.feature]
                if node.threshold is not None:
                    return values <= node.threshold
                return np.isin(values, np.flatnonzero(node.left))

            n = columns.shape[1]
            return pa.array(sum(t.weight * t.predict(goes_left, n) for t in trees), pa.float64())

        score.__annotations__ = {"x": pa.Array, "return": pa.Array}
        return dataset.withColumn(self.prediction, F.arrow_udf(score, "double")(vector_to_array(self.features)))
