"""Packing documents into sequences of one length by fitted patterns.

The lengths of all pieces are counted. Patterns of up to three lengths that together fill a sequence
are enumerated on a coarse grid, and non-negative least squares says how often each is to be used so
that the lengths' histogram is met. The counts are rounded down and cut into runs of exact lengths;
the gaps they leave and the pieces not used are filled best-fit, longest first. All this works on
counts per length, so its size depends on the sequence length and not on the number of documents.
Pieces then find their place by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tilecast.llm.text import runs, whole_text
from tilecast.llm.tokens import word_encoder
from tilecast.llm.words import ranges
from tilecast.session import materialize

#: Tokens in a sequence, steps of the grid in a sequence, and lengths in a pattern.
SEQUENCE, GRID, DEPTH = 4096, 128, 3
PIECES = "piece int, start long, length long, ids_crc32 long, ids binary, chunk long, place long"


def patterns(grid: int = GRID, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """All ascending tuples of up to ``depth`` positive steps with the sum ``grid``."""
    out: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], least: int, left: int) -> None:
        out.append((*head, left))
        if len(head) + 1 < depth:
            for step in range(least, left // 2 + 1):
                extend((*head, step), step, left - step)

    extend((), 1, grid)
    return out


def nnls(a: np.ndarray, b: np.ndarray, most_steps: int = 2000) -> np.ndarray:
    """Least squares with non-negative weights, by an active set."""
    gram, target = a.T @ a, a.T @ b
    x, used = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slack = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(most_steps):
        slope = np.where(used, -np.inf, target - gram @ x)
        best = int(slope.argmax())
        if slope[best] <= slack:
            break
        used[best] = True
        while True:
            at = np.flatnonzero(used)
            z = np.linalg.lstsq(gram[np.ix_(at, at)], target[at], rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            share = (x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)).min()
            x[at] += share * (z - x[at])
            drop = at[x[at] <= 1e-12 * max(1.0, x.max())]
            if not len(drop):
                drop = at[low]
            x[drop] = 0
            used[drop] = False
            if not used.any():
                break
        if not used.any():
            break
    return x


def plan_sequences(histogram: dict[int, int], sequence: int = SEQUENCE, grid: int = GRID) -> list[tuple[tuple[int, ...], int]]:
    """Groups of lengths, each at most ``sequence`` in sum, and how often each is used.

    Together they use every length of ``histogram`` exactly as often as it is counted there.
    """
    step = -(-sequence // grid)
    left = {n: c for n, c in histogram.items() if c > 0}
    shelves: list[list[int]] = [[] for _ in range(grid + 1)]  # lengths of each step, longest last
    for n in sorted(left):
        shelves[-(-n // step)].append(n)
    counts = np.array([sum(left[n] for n in s) for s in shelves[1:]], float)
    shapes = patterns(grid)
    matrix = np.zeros((grid, len(shapes)))
    for j, shape in enumerate(shapes):
        for s in shape:
            matrix[s - 1, j] += 1
    weights = nnls(matrix, counts) if counts.any() else np.zeros(len(shapes))

    bins: dict[tuple[int, ...], int] = {}

    def take(shape: tuple[int, ...], times: int) -> None:
        """Use a pattern: its longest step takes the longest lengths, the others the longest that then fit."""
        while times > 0:
            chosen: list[int] = []
            room, need = sequence, {}
            for s in reversed(shape):
                fit = [n for n in shelves[s] if left[n] > need.get(n, 0) and n <= room]
                if not fit:
                    return
                n = fit[-1]
                chosen.append(n)
                need[n] = need.get(n, 0) + 1
                room -= n
            run = min(times, *(left[n] // k for n, k in need.items()))
            for n, k in need.items():
                left[n] -= k * run
            key = tuple(chosen)
            bins[key] = bins.get(key, 0) + run
            times -= run

    for j in np.argsort(-weights, kind="stable"):
        if weights[j] >= 1:
            take(shapes[j], int(weights[j]))

    # best fit for the rest, longest first, into the gaps of all groups so far
    space: dict[int, list[tuple[int, ...]]] = {}
    for key in bins:
        space.setdefault(sequence - sum(key), []).append(key)
    order = sorted(space)
    for n in sorted(left, reverse=True):
        while left[n] > 0:
            i = bisect_left(order, n)
            if i == len(order):
                # as many of this length as fit, the rest of the count in one group less full
                per = max(1, sequence // n)
                full, rest = divmod(left[n], per)
                new = [((n,) * per, full)] + ([((n,) * rest, 1)] if rest else [])
                left[n] = 0
                for key, times in new:
                    if times:
                        if key not in bins:
                            gap = sequence - sum(key)
                            if gap not in space:
                                space[gap] = []
                                insort(order, gap)
                            space[gap].append(key)
                        bins[key] = bins.get(key, 0) + times
                continue
            gap = order[i]
            key = space[gap][-1]
            many = gap // n
            times = min(bins[key], left[n] // many)
            if times == 0:  # fewer than one gap's worth are left
                many, times = left[n], 1
            left[n] -= many * times
            bins[key] -= times
            if not bins[key]:
                del bins[key]
                space[gap].pop()
                if not space[gap]:
                    del space[gap]
                    order.pop(i)
            grown, room = key + (n,) * many, gap - many * n
            if grown not in bins:
                if room not in space:
                    space[room] = []
                    insort(order, room)
                space[room].append(grown)
            bins[grown] = bins.get(grown, 0) + times
    return sorted(bins.items())


def slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Where the ranks of each length go, sorted by (length, first rank).

    Ranks from ``first`` on, ``every`` to a sequence, go to the sequence ``base`` and those behind it,
    at ``offset`` and, within a sequence, one length further each.
    """
    rows, taken, base = [], {}, 0
    for key, times in plan:
        offset = 0
        for n in sorted(set(key), reverse=True):
            many = key.count(n)
            first = taken.get(n, 0)
            rows.append((n, first, many, base, offset))
            taken[n] = first + many * times
            offset += n * many
        base += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(len(rows), 5)
    return tuple(np.ascontiguousarray(table[:, k]) for k in range(5))


def cut_pieces(docs: DataFrame, file: str, sequence: int = SEQUENCE, end: int = 1, with_ids: bool = False) -> DataFrame:
    """doc_id and the columns of PIECES: each whole text's ids and ``end``, cut only where longer than ``sequence``.

    ``chunk`` numbers the runs of pieces made together, ``place`` counts the pieces of one length
    inside it. The result must be written before use, since chunks depend on the task.
    """
    names = ["doc_id", *(p.split()[0] for p in PIECES.split(", "))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seen = TaskContext.get().partitionId(), np.zeros(sequence + 1, np.int64)
        for batch in batches:
            text = batch.column("text")
            for lo, hi in runs(text):
                ids, counts = word_encoder(file).encode_with(text.slice(lo, hi - lo), end)
                ids = ids.astype("<u4")
                many = -(-counts // sequence)  # pieces of each text
                piece = ranges(np.zeros(len(many), np.int64), many)
                start = piece * sequence
                begins = np.repeat(np.cumsum(counts) - counts, many) + start
                length = np.minimum(np.repeat(counts, many) - start, sequence)
                raw = [ids[b : b + n].tobytes() for b, n in zip(begins.tolist(), length.tolist(), strict=True)]
                # how many pieces of its length the chunk has before each one
                order = np.argsort(length, kind="stable")
                place = np.empty(len(length), np.int64)
                place[order] = np.arange(len(length)) - np.searchsorted(length[order], length[order])
                place += seen[length]
                seen += np.bincount(length, minlength=sequence + 1)
                doc = batch.column("doc_id").take(pa.array(lo + np.repeat(np.arange(len(many)), many)))
                columns = [
                    doc, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(list(map(zlib.crc32, raw)), pa.int64()),
                    pa.array(raw if with_ids else [None] * len(raw), pa.binary()), pa.array(np.full(len(length), chunk), pa.int64()), pa.array(place),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(cut, f"doc_id {kind}, {PIECES}")


def pack(docs: DataFrame, file: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Every piece with sequence_id and offset, gapless from 0 in each sequence.

    doc_id, piece, start, length, ids_crc32, ids (binary where wanted, else null), sequence_id,
    offset. Null texts are empty and hold the end id alone; repeated rows are packed each. Pieces are
    ranked by counts per chunk and length, never sorted or gathered by length, so a length that a
    third of all pieces share costs no more than others. The plan (a few numbers per group of
    lengths) goes to every task.
    """
    pieces = materialize(cut_pieces(docs, file, sequence, with_ids=with_ids), "pieces")
    counts = pieces.groupBy("chunk", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = docs.sparkSession.sparkContext.broadcast(slots(plan_sequences(histogram, sequence)))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("chunk", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(starts, ["chunk", "length"]).withColumn("rank", F.col("before") + F.col("place"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, many, bases, offsets = table.value
        rows = np.rec.fromarrays([lengths, firsts], names="a,b") if len(lengths) else None
        top = int(firsts.max(initial=0)) + 1
        for batch in batches:
            n = np.asarray(batch.column("length").to_numpy(zero_copy_only=False), np.int64)
            rank = np.asarray(batch.column("rank").to_numpy(zero_copy_only=False), np.int64)
            if rows is None or not len(n):
                continue
            k = np.searchsorted(lengths * top + firsts, n * top + np.minimum(rank, top - 1), side="right") - 1
            turn = rank - firsts[k]
            sequence_id = bases[k] + turn // many[k]
            offset = offsets[k] + (turn % many[k]) * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(sequence_id), pa.array(offset)], [*columns, "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    return ranked.select(*columns, "rank").mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"
    )


def packing_digest(docs: DataFrame, file: str, sequence: int = SEQUENCE) -> DataFrame:
    """What op10 returns; odd rows as in ``pack``. An empty table gives no pieces."""
    return pack(docs, file, sequence).drop("ids")
