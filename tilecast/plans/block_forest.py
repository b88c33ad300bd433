"""Random forests over binned rows.

The forest is that of Spark ML's RandomForestRegressor: the same bins and gains, the whole table drawn
with Poisson(1) weights for each tree, a random third of the features for each node. Only the draws are
numpy's. Spark ML keeps the weights of all trees beside each row; here a row is a byte per feature and 8
bytes for the label, and the weights are drawn again in each pass from the numbers of tree and block. One
job per level sums the histograms of a block with numpy; they are summed up and split in a shuffle by
tree, so the driver sees splits only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.plans.boosting import _EPSILON, _SCHEMA, _TIE, OnBins, _read, _to_blocks
from tilecast.session import delete_tables, materialize, recorded

#: Up to so many rows the forest is Spark ML's own, whose weights of all trees fit beside the rows.
SPARK_ML_ROWS = 1_000_000
#: Cells of histograms that are summed in one pass; each is two numbers in every task.
CELLS = 2**24
#: Weights that a 16-bit number does not settle.
_UNSETTLED = 255


@dataclass
class Level:
    """The nodes of a tree's level that were open: their splits, and which nodes follow.

    ``left`` tells for each bin whether it goes left, ``child`` holds the numbers of both children among
    the open nodes of the next level or -1, ``worth`` their means; a node without a split has no gain.
    """

    feature: np.ndarray
    left: np.ndarray
    worth: np.ndarray
    gain: np.ndarray
    child: np.ndarray

    def sides(self, both: np.ndarray, other, width: int) -> np.ndarray:
        """What ``both`` has for the side that each node and bin goes to; unseen bins go right.

        One node more than there are stands for all rows in leaves; it has ``other``.
        """
        nodes, seen = self.left.shape
        found = np.full((nodes + 1, width), other, both.dtype)
        found[:nodes] = both[:, 1:]
        found[:nodes, :seen] = np.where(self.left, both[:, :1], both[:, 1:])
        return found.ravel()

    def table(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Each node's feature, and what follows on each of its bins."""
        closed = int(self.child.max(initial=-1)) + 1
        following = self.sides(np.where(self.child < 0, closed, self.child), closed, width)
        return np.append(self.feature.astype(np.int64), 0), following


@dataclass
class Piece:
    """Open nodes ``first`` to ``last`` of a tree, and the features drawn for each."""

    tree: int
    first: int
    last: int
    drawn: np.ndarray


def _poisson_table() -> tuple[np.ndarray, np.ndarray]:
    """Poisson(1) weights by the upper 16 bits of a uniform number, and their distribution."""
    shares = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    edges = np.arange(65_537) / 65_536
    low, high = np.searchsorted(shares, edges[:-1], "right"), np.searchsorted(shares, edges[1:], "left")
    return np.where(low == high, low, _UNSETTLED).astype(np.uint8), shares


_WEIGHTS, _SHARES = _poisson_table()


def poisson_weights(key: list[int], n: int) -> np.ndarray:
    """``n`` Poisson(1) numbers, fixed by ``key``."""
    stream = np.random.SFC64(key)
    upper = stream.random_raw(-(-n // 4)).view(np.uint16)[:n]
    weights = _WEIGHTS.take(upper)
    open_ones = np.flatnonzero(weights == _UNSETTLED)
    if len(open_ones):
        exact = (upper[open_ones] + np.random.Generator(stream).random(len(open_ones))) / 65_536
        weights[open_ones] = np.searchsorted(_SHARES, exact, "right")
    return weights


def _walk(tables: list, width: int, flat: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The number of each row's open node, or one more than there are where it is in a leaf."""
    node = np.zeros(len(rows), np.int64)
    for feature, following in tables:
        at = feature.take(node, mode="clip")
        at += rows
        node *= width
        node += flat.take(at, mode="clip")
        node = following.take(node, mode="clip")
    return node


def _numbered(to_blocks):
    """Blocks with a number each, which stays with them wherever they are sent."""

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        for number, block in enumerate(to_blocks(batches)):
            yield pa.RecordBatch.from_arrays([*block.columns, pa.array([first + number])], [*block.schema.names, "number"])

    return run


def _sums(trees: list[list[Level]], pieces: list[Piece], sizes: list[int], kind: type, seed: int, bootstrap: bool):
    """Per piece and drawn feature the weights and weighted labels by node and bin; squares by node."""
    d, width = len(sizes), max(sizes)

    def run(blocks):
        tables = {p.tree: [level.table(width) for level in trees[p.tree]] for p in pieces}
        places = [np.ascontiguousarray(p.drawn.T.astype(np.int64)) for p in pieces]
        found = None
        for *block, number in blocks:
            bins, y = _read(block, kind)
            if found is None:
                cells = [(p.drawn.shape[1], (p.last - p.first) * width) for p in pieces]
                found = [(np.zeros(c), np.zeros(c), np.zeros(p.last - p.first)) for c, p in zip(cells, pieces)]
            order = np.argsort(y == 0, kind="stable")  # labels of 0 are last and left out of sums of labels
            flat, y = bins.T[order].ravel(), y[order]
            whole = np.arange(0, len(y) * d, d)
            tree = None
            for piece, place, (counts, totals, squares) in zip(pieces, places, found):
                if piece.tree != tree:
                    tree, rows, labels, weights = piece.tree, whole, y, np.ones(len(y))
                    if bootstrap:
                        weights = poisson_weights([seed, tree, number], len(y))
                        kept = np.flatnonzero(weights > 0)
                        rows, labels, weights = (a.take(kept) for a in (rows, labels, weights))
                    node = _walk(tables[tree], width, flat, rows)
                _add(piece, place, node, rows, labels, weights, flat, width, counts, totals, squares)
        for k, sums in enumerate(found or []):
            yield k, (sums[0].astype(np.uint32), *sums[1:])

    return run


def _add(piece, place, node, rows, labels, weights, flat, width, counts, totals, squares) -> None:
    n = piece.last - piece.first
    if node.max(initial=0) >= piece.last or piece.first:
        here = np.flatnonzero((node >= piece.first) & (node < piece.last))
        node, rows, labels, weights = (a.take(here) for a in (node - piece.first, rows, labels, weights))
    weights = weights.astype(float)
    k = np.count_nonzero(labels)
    labels = labels[:k]
    weighted = weights[:k] * labels
    squares += np.bincount(node[:k], weighted * labels, n)
    base = node * width
    for j in range(len(place)):
        at = place[j].take(node, mode="clip")
        at += rows
        cell = np.add(base, flat.take(at, mode="clip"), out=at)
        counts[j] += np.bincount(cell, weights, n * width)
        totals[j] += np.bincount(cell[:k], weighted, n * width)


def _splits(pieces: list[Piece], borders: list[np.ndarray | None], width: int):
    """Sums of all tasks, added up, as the splits of each piece's nodes."""

    def run(parts) -> Iterator:
        whole = {}
        for k, sums in parts:
            if k in whole:
                for a, b in zip(whole[k], sums):
                    a += b
            else:
                whole[k] = [a.astype(float) for a in sums]
        for k, (counts, totals, squares) in whole.items():
            shape = len(counts), -1, width
            sums = (a.reshape(shape).swapaxes(0, 1) for a in (counts, totals))
            yield k, best_splits(*sums, squares, pieces[k].drawn, borders)

    return run


def best_splits(counts, totals, squares, drawn, borders) -> tuple[np.ndarray, ...]:
    """Feature, bins that go left, means and weights of both sides, and gain of the best split of each node.

    ``counts`` and ``totals`` go by node, drawn feature and bin. A node that no split explains has gain 0.
    """
    count, total = counts[:, 0].sum(1), totals[:, 0].sum(1)
    nodes = np.arange(len(count))
    order = np.broadcast_to(np.arange(counts.shape[2]), counts.shape)
    sets = np.isin(drawn, [j for j, b in enumerate(borders) if b is None])
    if sets.any():
        order = order.copy()
        means = np.divide(totals[sets], counts[sets], out=np.full(counts[sets].shape, np.inf), where=counts[sets] > 0)
        order[sets] = np.argsort(means, kind="stable", axis=1)
        counts, totals = (np.take_along_axis(a, order, 2) for a in (counts, totals))
    c, s = (a.cumsum(2)[:, :, :-1] for a in (counts, totals))
    n, t = count[:, None, None], total[:, None, None]
    valid = (c > 0) & (c < n)
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = np.where(valid, s * s / c + (t - s) ** 2 / (n - c) - t * t / n, -np.inf)
        mean = total / count
        varies = squares / count - mean**2 >= _EPSILON
    if not gains.shape[2]:
        gains, c, s = (np.full((*counts.shape[:2], 1), v) for v in (-np.inf, 0.0, 0.0))
    best = gains.max(2)
    top = best.max(1)
    at = np.argmax(best >= (top * (1 - _TIE))[:, None], axis=1)
    cut = np.argmax(gains[nodes, at] >= (best[nodes, at] * (1 - _TIE))[:, None], axis=1)
    split = varies & (top > _TIE * squares)
    c, s = c[nodes, at, cut], s[nodes, at, cut]
    left = np.zeros((len(nodes), counts.shape[2]), bool)
    np.put_along_axis(left, order[nodes, at], np.arange(counts.shape[2]) <= cut[:, None], 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        worth = np.where(split[:, None], np.stack([s / c, (total - s) / (count - c)], 1), mean[:, None])
    heavy = np.where(split[:, None], np.stack([c, count - c], 1), 0.0)
    return drawn[nodes, at], left, worth, heavy, np.where(split, top, 0.0)


def _passes(pieces: list[Piece], cells: int) -> Iterator[list[Piece]]:
    """Neighbouring pieces whose nodes together have at most ``CELLS`` cells, if more than one."""
    part, held = [], 0
    for piece in pieces:
        more = (piece.last - piece.first) * cells
        if part and held + more > CELLS:
            yield part
            part, held = [], 0
        part.append(piece)
        held += more
    if part:
        yield part


class BlockForest(OnBins):
    """``n_trees`` trees of ``depth`` levels at most on squared error, whose mean is predicted.

    Each node sees a random ``share`` of the features. With ``bootstrap`` each tree sees the rows with
    Poisson(1) weights, else with weight 1.
    """

    def __init__(
        self, n_trees, depth, seed, label, prediction, share=1 / 3, bootstrap=True, max_bins=32, features="features"
    ):
        super().__init__(n_trees, depth, seed, label, prediction, max_bins, features)
        self.share, self.bootstrap = share, bootstrap
        self.entropy = seed % 2**64  # numpy takes no negative seeds

    def _fit(self, dataset: DataFrame) -> BlockForestModel:
        rows, borders, sizes, kind = self._binned(dataset)
        with recorded() as written:
            blocks = rows.mapInArrow(_numbered(_to_blocks(borders, kind)), f"{_SCHEMA}, number long")
            blocks = materialize(blocks, "blocks")
            trees = self._grow(blocks, borders, sizes, kind)
            delete_tables(dataset.sparkSession, written)
        return BlockForestModel(trees, borders, sizes, self.features, self.prediction)

    def _grow(self, blocks, borders, sizes, kind) -> list[list[Level]]:
        parallel = blocks.sparkSession.sparkContext.defaultParallelism
        # each task ships its histograms, so there are two to a core, of about as many blocks each
        blocks = blocks.repartition(2 * parallel).rdd.map(lambda r: (bytes(r[0]), bytes(r[1]), r[2]))
        blocks.persist(StorageLevel.MEMORY_AND_DISK)
        trees: list[list[Level]] = [[] for _ in range(self.n_trees)]
        open_nodes = [1] * self.n_trees
        taken = max(1, math.ceil(self.share * len(sizes)))
        for level in range(self.depth):
            pieces = [p for t, n in enumerate(open_nodes) if n for p in self._pieces(t, level, n, taken, sizes)]
            if not pieces:
                break
            found = []
            for part in _passes(pieces, taken * max(sizes)):
                sums = _sums(trees, part, sizes, kind, self.entropy, self.bootstrap)
                split = _splits(part, borders, max(sizes))
                shuffled = blocks.mapPartitions(sums).partitionBy(min(len(part), parallel), int)
                found += [r for _, r in sorted(shuffled.mapPartitions(split).collect(), key=lambda r: r[0])]
            grown = [[] for _ in trees]
            for piece, splits in zip(pieces, found):
                grown[piece.tree].append(splits)
            for t, parts in enumerate(grown):
                open_nodes[t] = 0
                if parts:
                    feature, left, worth, heavy, gain = (np.concatenate(p) for p in zip(*parts))
                    # a side of one draw has one label
                    child = np.where(heavy > 1, 0, -1) if level < self.depth - 1 else np.full(heavy.shape, -1)
                    open_nodes[t] = int((child == 0).sum())
                    child[child == 0] = np.arange(open_nodes[t])
                    trees[t].append(Level(feature, left, worth, gain, child))
        blocks.unpersist()
        return trees

    def _pieces(self, tree: int, level: int, nodes: int, taken: int, sizes: list[int]) -> list[Piece]:
        draws = np.random.default_rng([self.entropy, tree, level]).random((nodes, len(sizes)))
        drawn = np.sort(np.argsort(draws, axis=1)[:, :taken], axis=1).astype(np.uint16)
        most = max(1, CELLS // (taken * max(sizes)))
        return [Piece(tree, i, min(i + most, nodes), drawn[i : i + most]) for i in range(0, nodes, most)]


class BlockForestModel(Model):
    """Fitted trees; rows are scored where they lie."""

    def __init__(self, trees, borders, sizes, features: str, prediction: str):
        super().__init__()
        self.trees, self.borders, self.sizes = trees, borders, sizes
        self.features, self.prediction = features, prediction

    @property
    def featureImportances(self) -> DenseVector:
        """What the splits of each feature explain, as shares of all, averaged over trees."""
        total = np.zeros(len(self.sizes))
        for tree in self.trees:
            own = sum(np.bincount(level.feature, level.gain, len(total)) for level in tree)
            total += own / own.sum() if own.sum() > 0 else own
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees, borders, d, width = self.trees, self.borders, len(self.sizes), max(self.sizes) + 1

        tables = []

        def score(x: pa.Array) -> pa.Array:
            if not tables:  # once per task
                for tree in trees:
                    values = [level.sides(level.worth, 0.0, width) for level in tree]
                    tables.append([(*level.table(width), v, len(level.gain)) for level, v in zip(tree, values)])
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            bins = np.empty(x.shape, np.int64)
            for j, border in enumerate(borders):
                if border is None:  # the last bin is for levels never seen
                    bins[:, j] = np.where(np.isin(x[:, j], np.arange(width - 1)), x[:, j], width - 1)
                else:
                    bins[:, j] = np.searchsorted(border, x[:, j])
            total = np.zeros(len(x))
            for tree in tables:
                total += _predict(tree, width, bins.ravel(), np.arange(0, bins.size, d))
            return pa.array(total / len(trees), pa.float64())

        score.__annotations__ = {"x": pa.Array, "return": pa.Array}
        return dataset.withColumn(self.prediction, F.arrow_udf(score, "double")(vector_to_array(self.features)))


def _predict(tree: list, width: int, flat: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The mean of the leaf that each row ends in."""
    found, node = np.zeros(len(rows)), np.zeros(len(rows), np.int64)
    for feature, following, worth, nodes in tree:
        cell = flat.take(feature.take(node) + rows) + node * width
        np.copyto(found, worth.take(cell), where=node < nodes)
        node = following.take(cell)
    return found


class Forest(BlockForest):
    """A forest that is Spark ML's own, with its draws, up to ``SPARK_ML_ROWS`` rows.

    As there, a node sees a third of the features, and all of them where there is one tree only.
    """

    def __init__(self, n_trees, depth, seed, label, prediction):
        super().__init__(n_trees, depth, seed, label, prediction, 1 / 3 if n_trees > 1 else 1.0)

    def _fit(self, dataset: DataFrame) -> Model:
        if self.depth > 0 and dataset.count() > SPARK_ML_ROWS:
            return super()._fit(dataset)
        columns = {"labelCol": self.label, "predictionCol": self.prediction, "featuresCol": self.features}
        return RandomForestRegressor(numTrees=self.n_trees, maxDepth=self.depth, seed=self.seed, **columns).fit(dataset)
