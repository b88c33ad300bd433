"""Hard negatives by inner product, through cover trees over norm-augmented candidates.

Every candidate x gets one more coordinate, sqrt(M^2 - |x|^2), so that all lie on a sphere of radius M,
the largest norm. On it a node of the tree is a cap: a centre and a covering angle. For a query q at an
angle t from the centre all inner products in a cap of angle r are at most |q| M cos(t - r) and at
least |q| M cos(t + r). The top level of the tree holds at most ``CELLS`` centres, chosen farthest-first
from a bounded sample of rows; it deals all rows to cells, and queries to the cells that their windows
of scores meet. Large cells are split by a hash. Each part gets the lower levels: caps of half the
angle of the level above, as long as they are clearly fewer than the rows in them.

A search goes down level by level, drops nodes wholly outside a query's windows, then takes each
query's leaves in the order of their upper bounds until the best one left is worse than what it has.
Leaves are verified exactly: components are whole numbers, so scores below 2^53 are exact doubles.

Rows without an id, a label or a vector, and those with a null or non-finite component take no part;
of rows that repeat an id the one with the smallest (label, vector) does. A shorter vector counts as
padded with zeros. Ties go by the smaller id. Empty tables, or anchors without a positive or without a
row in the window, give no rows. Only the named columns are read, so no other can clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilecast.session import materialize

#: Rows of a tree, about; centres of the top level, at most; rows that they are chosen from, at most.
ROWS, CELLS, SAMPLE = 4096, 256, 4096
#: Anchors that meet a tree in one task, about, and anchors searched side by side.
BLOCK, BATCH = 1 << 16, 256
#: A node is split while it has more rows than this, and if its caps are at most one in SPARSE of them.
LEAF, SPARSE = 64, 8
#: Bounds are widened by this share of the largest score, and angles by as much, more than arcs may err.
SLACK = 1e-7


def whole_numbers(rows: DataFrame, id_col: str, label: Column, vector: str, scale: int = 256) -> DataFrame:
    """vec_id, label, v: the rows that take part, with components floor(scale * x) as doubles."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("double"))
    label = label.cast("bigint").alias("label")
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), label, F.when(fine, v).alias("v"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows of ``dim`` doubles, padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def on_sphere(x: np.ndarray, most: float) -> np.ndarray:
    """Unit vectors: x and the coordinate that brings its norm to ``most``, over ``most``."""
    rest = np.sqrt(np.maximum(most * most - (x * x).sum(1), 0.0))
    return np.column_stack([x, rest]) / most


def arcs(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def caps(points: np.ndarray, angle: float, most: int) -> tuple[list[int], np.ndarray, np.ndarray] | None:
    """Centres, farthest first, until all points lie within ``angle`` of one: their rows, each point's
    nearest centre, and its angle from it. None if that takes more than ``most`` centres."""
    centres, owner, least = [0], np.zeros(len(points), np.int64), np.cos(angle)
    near = points @ points[0]
    while near.min() < least:
        if len(centres) == most:
            return None
        far = int(near.argmin())
        new = points @ points[far]
        owner[new > near] = len(centres)
        near = np.maximum(near, new)
        centres.append(far)
    return centres, owner, arcs(near) + SLACK


@dataclass
class Level:
    """Nodes of one level: centres on the sphere, covering angles, and each one's parent in the level above."""

    centres: np.ndarray
    angles: np.ndarray
    parent: np.ndarray


class CoverTree:
    """Levels of caps over the rows of one part; the last level's nodes are the leaves, rows in their order."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, most: float):
        points, self.most = on_sphere(x, most), most
        members = [(np.argsort(ids, kind="stable"), True)]  # rows of a node, and whether it may be split
        mean = points.mean(0)
        mean /= np.linalg.norm(mean) or 1.0
        angle = float(arcs(points @ mean).max()) + SLACK
        self.levels = [Level(mean[None], np.array([angle]), np.zeros(1, np.int64))]
        while angle > 1e-3 and any(splits for _, splits in members):
            angle /= 2
            nodes, radii, parents, below = [], [], [], []
            for p, (m, splits) in enumerate(members):
                found = caps(points[m], angle, max(2, len(m) // SPARSE)) if splits and len(m) > LEAF else None
                if found is None:  # as it is, one level lower; smaller caps would be more
                    nodes.append(self.levels[-1].centres[p])
                    radii.append(self.levels[-1].angles[p])
                    parents.append(p)
                    below.append((m, False))
                    continue
                centres, owner, off = found
                for k, c in enumerate(centres):
                    mine = owner == k
                    nodes.append(points[m[c]])
                    radii.append(off[mine].max(initial=0.0))
                    parents.append(p)
                    below.append((m[mine], True))
            self.levels.append(Level(np.array(nodes), np.array(radii), np.array(parents)))
            members = below
        members = [m for m, _ in members]
        self.ends = np.cumsum([len(m) for m in members])
        order = np.concatenate(members)
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]

    def bounds(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The upper bound of every leaf for each query, -inf where no score can lie in [low, high]."""
        reach = np.linalg.norm(q, axis=1) * self.most
        slack = SLACK * self.most * self.most
        unit = q / np.where(reach > 0, reach / self.most, 1.0)[:, None]
        above = np.full((len(q), 1), np.inf)
        for level in self.levels:
            upper = above[:, level.parent]
            met = np.flatnonzero((upper > -np.inf).any(0))  # nodes below a node that some query needs
            t = arcs(unit @ level.centres[met, :-1].T)
            top = reach[:, None] * np.cos(np.maximum(t - level.angles[met], 0.0)) + slack
            least = reach[:, None] * np.cos(np.minimum(t + level.angles[met], np.pi)) - slack
            top = np.minimum(top, upper[:, met])
            top[(top < low[:, None]) | (least > high[:, None])] = -np.inf
            above = np.full(upper.shape, -np.inf)
            above[:, met] = top
        return above

    def best(self, ids, labels, q, windows, same: bool, k: int) -> tuple[np.ndarray, ...]:
        """The first ``k`` rows by (score, smaller id) in each window of each query, other ids only, of the
        same label or of another one: numbers of query and window, id, score.

        ``windows`` has the shape (queries, windows, 2), both ends in. An empty window has its low end higher.
        """
        low, high = windows[..., 0], windows[..., 1]
        open_ = low <= high
        upper = self.bounds(q, np.where(open_, low, np.inf).min(1), np.where(open_, high, -np.inf).max(1))
        scores = np.full((len(q), len(self.x)), np.nan)
        kth = np.where(open_[..., None], low[..., None], np.inf) * np.ones(k)  # each window's k best so far, or its low end
        while True:
            need = kth.min((1, 2))
            upper[upper < need[:, None]] = -np.inf
            leaf = upper.argmax(1)
            going = np.flatnonzero(upper[np.arange(len(q)), leaf] > -np.inf)
            if not len(going):
                break
            for node in np.unique(leaf[going]):
                a = going[leaf[going] == node]
                rows = slice(self.ends[node - 1] if node else 0, self.ends[node])
                upper[a, node] = -np.inf
                part = q[a] @ self.x[rows].T
                fits = (self.labels[rows] == labels[a][:, None]) == same
                fits &= self.ids[rows] != ids[a][:, None]
                scores[a[:, None], np.arange(rows.start, rows.stop)] = np.where(fits, part, np.nan)
                for w in range(windows.shape[1]):
                    inside = fits & (part >= low[a, w][:, None]) & (part <= high[a, w][:, None])
                    both = np.concatenate([kth[a, w], np.where(inside, part, -np.inf)], 1)
                    kth[a, w] = -np.partition(-both, k - 1, 1)[:, :k]
        out = []
        for w in range(windows.shape[1]):
            least = kth[:, w].min(1)[:, None]
            a, r = np.nonzero((scores >= least) & (scores <= high[:, w][:, None]))
            found = scores[a, r]
            order = np.lexsort((self.ids[r], -found, a))
            a, r, found = a[order], r[order], found[order]
            first = np.searchsorted(a, a)
            keep = np.arange(len(a)) - first < k
            out.append((a[keep], np.full(keep.sum(), w), self.ids[r[keep]], found[keep]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


@dataclass
class TopLevel:
    """The tree's first level, known to every task: at most CELLS caps, and the parts that each is split into."""

    dim: int
    most: float
    centres: np.ndarray
    angles: np.ndarray | None = None
    parts: np.ndarray | None = None

    def cells_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosines = on_sphere(x, self.most) @ self.centres.T
        cell = cosines.argmax(1)
        return cell, arcs(cosines[np.arange(len(x)), cell])

    def parts_within(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
        """For each query the numbers of the parts whose cell may hold a score in [low, high]."""
        reach = np.linalg.norm(q, axis=1)[:, None] * self.most
        slack = SLACK * self.most * self.most
        t = arcs(q @ self.centres[:, :-1].T * self.most / np.where(reach > 0, reach, 1.0))
        top = reach * np.cos(np.maximum(t - self.angles, 0.0)) + slack
        least = reach * np.cos(np.minimum(t + self.angles, np.pi)) - slack
        met = (top >= low[:, None]) & (least <= high[:, None])
        ends = np.cumsum(self.parts)
        cell_of_part = np.repeat(np.arange(len(ends)), self.parts)
        return [np.flatnonzero(row[cell_of_part]) for row in met]


def top_level(base: DataFrame) -> TopLevel | None:
    """Centres from a bounded sample of rows, by a hash of the id; None for an empty table."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    row = base.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(norm).alias("most")).first()
    if not row["n"]:
        return None
    dim, most = max(row["dim"], 1), (row["most"] or 1.0) * (1 + 1e-12)
    drawn = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toArrow()
    points = on_sphere(matrix(drawn["v"], dim), most)
    wanted = int(min(CELLS, max(1, -(-row["n"] // ROWS)), len(points)))
    chosen, off = [0], arcs(points @ points[0])
    while len(chosen) < wanted and off.max() > 1e-6:
        chosen.append(int(off.argmax()))
        off = np.minimum(off, arcs(points @ points[chosen[-1]]))
    return TopLevel(dim, most, points[chosen])


def deal(base: DataFrame) -> tuple[DataFrame, TopLevel] | None:
    """All rows with the number of their part, and the top level with its covering angles."""
    top = top_level(base)
    if top is None:
        return None

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, off = top.cells_of(matrix(b.column("v"), top.dim))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(off)], [*b.schema.names, "cell", "off"])

    dealt = materialize(base.mapInArrow(cells, "vec_id long, label long, v array<double>, cell int, off double"), "cells")
    stats = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("off").alias("off")).collect()  # CELLS rows at most
    k = len(top.centres)
    top.angles, top.parts = np.zeros(k), np.zeros(k, np.int64)
    for r in stats:
        top.angles[r["cell"]], top.parts[r["cell"]] = r["off"] + SLACK, -(-r["n"] // ROWS)
    starts = np.cumsum(top.parts) - top.parts
    of = lambda a: F.get(F.array(*[F.lit(int(x)) for x in a]), F.col("cell"))
    part = of(starts) + F.pmod(F.xxhash64("vec_id"), of(np.maximum(top.parts, 1)))
    return dealt.select("vec_id", "label", "v", part.cast("int").alias("part")), top


FOUND = "anchor_id long, window int, found_id long, score long"


def search(rows: DataFrame, asked: DataFrame, top: TopLevel, n_anchors: int, same: bool, k: int) -> DataFrame:
    """``asked`` holds vec_id, label, v, low, high (an array each) and part: what its parts' trees find."""
    blocks = -(-n_anchors // BLOCK) or 1
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    asked = asked.withColumn("block", block)
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def work(key: tuple[pa.Scalar, ...], here: pa.Table, there: pa.Table) -> pa.Table:
        out = []
        if here.num_rows and there.num_rows:
            of = lambda t: (t["vec_id"].to_numpy(), t["label"].to_numpy(), matrix(t["v"], top.dim))
            tree = CoverTree(*of(here), top.most)
            ids, labels, q = of(there)
            n_windows = len(there["low"][0])
            windows = np.stack([matrix(there[c], n_windows) for c in ("low", "high")], 2)
            for lo in range(0, len(ids), BATCH):
                s = slice(lo, lo + BATCH)
                a, *rest = tree.best(ids[s], labels[s], q[s], windows[s], same, k)
                out.append((ids[s][a], *rest))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0)] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.table([pa.array(c.astype(t.to_pandas_dtype())) for c, t in zip(columns, kinds, strict=True)], names=names)

    here, there = rows.groupBy("part", "block"), asked.groupBy("part", "block")
    return here.cogroup(there).applyInArrow(work, FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(
    base: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``base`` is what ``whole_numbers`` returns, ``anchors`` a condition on it. An anchor's positives are
    its first rows of the same label; their negatives are the first rows of another label whose score
    is between ``low`` and ``high`` per cent of the positive's.
    """
    base = materialize(base, "vectors")
    dealt = deal(base)
    if dealt is None:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return base.sparkSession.createDataFrame([], schema)
    rows, top = dealt
    asking = base.filter(anchors)
    n = asking.count()
    ends = (F.array(F.lit(-1e300)).alias("low"), F.array(F.lit(1e300)).alias("high"))
    every = F.explode(F.sequence(F.lit(0), F.lit(int(top.parts.sum()) - 1))).alias("part")
    found = search(rows, asking.select("*", *ends, every), top, n, True, positives)
    liked = materialize(_first(found, ["anchor_id"], positives).drop("window"), "positives")

    def floor(x: Column) -> Column:  # of x per cent
        return (x - F.pmod(x, F.lit(100))) / 100

    score = F.col("score")
    least, most = -floor(-score * low), floor(score * high)
    pair = F.struct("rank", "found_id", "score", least.alias("low"), most.alias("high"))
    pairs = liked.groupBy("anchor_id").agg(F.sort_array(F.collect_list(pair)).alias("pairs"))  # at most ``positives`` each
    pairs = pairs.select(F.col("anchor_id").alias("vec_id"), *[F.col(f"pairs.{c}").alias(c) for c in ("low", "high")])
    widened = [F.concat(c, F.array_repeat(F.lit(x), F.lit(positives) - F.size(c))).alias(c) for c, x in (("low", 1e300), ("high", -1e300))]
    windowed = asking.join(pairs, "vec_id").select("vec_id", "label", "v", *widened)
    routed = windowed.mapInArrow(_router(top, positives), ROUTED)
    routed = routed.select(*windowed.columns, F.explode("parts").alias("part"))
    found = _first(search(rows, routed, top, n, False, negatives), ["anchor_id", "window"], negatives)
    found = found.withColumnsRenamed({"found_id": "negative_id", "score": "negative_score"})
    named = liked.withColumnsRenamed({"found_id": "positive_id", "score": "positive_score"})
    named = named.withColumn("window", F.col("rank") - 1).drop("rank")
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return found.join(named, ["anchor_id", "window"]).select(*columns)


ROUTED = "vec_id long, label long, v array<double>, low array<double>, high array<double>, parts array<int>"


def _router(top: TopLevel, n_windows: int) -> Callable:
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            low, high = (matrix(b.column(c), n_windows) for c in ("low", "high"))
            some = low <= high
            parts = top.parts_within(
                matrix(b.column("v"), top.dim), np.where(some, low, np.inf).min(1), np.where(some, high, -np.inf).max(1)
            )
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            flat = np.concatenate([*parts, np.zeros(0, np.int64)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], [*b.schema.names, "parts"])

    return route


def mine_digest(embeddings: DataFrame) -> DataFrame:
    """The hard negatives of the rows whose vec_id is divisible by 50, labels of ids divisible by 7 shifted by one."""
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    base = whole_numbers(embeddings, "vec_id", shifted, "embedding")
    return mine(base, F.col("vec_id") % 50 == 0)
