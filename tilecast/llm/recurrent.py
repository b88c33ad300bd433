"""A gated recurrent language model in numpy, with a class-factored output softmax."""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass

import numpy as np

#: Steps of a window; lanes of a training, at least, and steps that its tokens should make.
WINDOW, MIN_LANES, MIN_STEPS = 32, 8, 64


@dataclass
class Layout:
    """Symbols 0 to heads - 1 are words with a place in an output class, the rest stand for groups of words.

    ``limits`` are the classes' limits in the row of head words; every group is a class by itself.
    """

    limits: list[int]
    groups: int

    @property
    def heads(self) -> int:
        return self.limits[-1]

    @property
    def symbols(self) -> int:
        return self.heads + self.groups

    @property
    def classes(self) -> int:
        return len(self.limits) - 1 + self.groups

    def class_of(self) -> np.ndarray:
        sizes = np.diff(self.limits)
        return np.concatenate([np.repeat(np.arange(len(sizes)), sizes), len(sizes) + np.arange(self.groups)]).astype(np.int64)


def initial(layout: Layout, counts: np.ndarray, hidden: int) -> dict[str, np.ndarray]:
    """Small random weights, and output biases that give the symbols' own frequencies."""
    rng, f = np.random.default_rng(11), np.float32
    of = layout.class_of()
    mass = np.bincount(of, counts + 0.5, layout.classes)
    return {
        "into": rng.normal(0, 0.3, (layout.symbols + 1, 3 * hidden)).astype(f),  # the last row begins a text
        "back": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(f),
        "class_w": np.zeros((hidden, layout.classes), f),
        "class_b": np.log(mass / mass.sum()).astype(f),
        "word_w": np.zeros((hidden, layout.heads), f),
        "word_b": np.log((counts + 0.5) / mass[of])[: layout.heads].astype(f),
    }


def forward(p: dict, x: np.ndarray, begins: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each of the T steps of ``x`` (T, B), from ``h`` (B, H), which is zeroed where a text
    ``begins`` (T, B): (T, B, H). What ``backward`` needs is appended to ``keep``.

    Each gate has an array of its own, so that all sums run over unbroken memory. What goes into the
    gates is negated beforehand, as their sigmoid is 1 / (1 + exp(-a)).
    """
    n, kind = h.shape[1], p["back"].dtype
    back = _apart(p["back"], n)
    gates_back, new_back = -back[:2], back[2]
    table = _apart(p["into"], n)
    np.negative(table[:2], out=table[:2])
    parts = np.take(table, x.reshape(-1), axis=1).reshape(3, *x.shape, n)  # in the end the gates and the new states
    out, two, one = np.empty((*x.shape, n), kind), np.empty((2, x.shape[1], n), kind), np.empty((x.shape[1], n), kind)
    first, fresh = h.astype(kind, copy=False), begins.any(1)
    h = first
    for t in range(len(x)):
        if fresh[t]:
            h = h.copy()
            h[begins[t]] = 0
        gates, new = parts[:2, t], parts[2, t]
        gates += np.matmul(h, gates_back, out=two)
        with np.errstate(over="ignore"):  # a closed gate: 1 / inf
            np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        new += np.matmul(np.multiply(gates[1], h, out=one), new_back)
        np.tanh(new, out=new)
        h = np.subtract(h, new, out=out[t])
        h *= gates[0]
        h += new
    if keep is not None:
        before = np.concatenate([first[None], out[:-1]])
        before[begins] = 0
        keep.append((before, *parts))
    return out


def _apart(a: np.ndarray, n: int) -> np.ndarray:
    """Columns for the gates z and r and the new state, (rows, 3n), as a copy (3, rows, n)."""
    return np.stack([a[:, :n], a[:, n : 2 * n], a[:, 2 * n :]])


def log_softmax_at(a: np.ndarray, at: np.ndarray, slopes: bool) -> np.ndarray:
    """Log softmax of each row at one column. ``a`` is overwritten, with ``slopes`` by the softmax less 1 at that column."""
    spot = np.arange(0, a.size, a.shape[1]) + at
    if max(a.max(), -a.min()) > 60:  # otherwise no sum of exponentials leaves the range of 4-byte floats
        a -= a.max(1, keepdims=True)
    flat = a.reshape(-1)
    out = flat[spot]
    np.exp(a, out=a)
    total = a @ np.ones(a.shape[1], a.dtype)
    out -= np.log(total)
    if slopes:
        a *= (1 / total)[:, None]
        flat[spot] -= 1
    return out


def log_likelihoods(p: dict, layout: Layout, of: np.ndarray, h: np.ndarray, y: np.ndarray, grad: dict | None = None):
    """Natural log probability of each target symbol given its state; with ``grad``, also its gradients.

    A word's is its class's plus its own inside the class. Rows are put in the order of their classes
    once, so that those of a class lie together. A last column of ones takes the biases in.
    """
    order = np.argsort(of[y].astype(np.uint16), kind="stable")
    y = y[order]
    c = of[y]
    n, slopes = h.shape[1], grad is not None
    states = np.ones((len(y), n + 1), h.dtype)
    states[:, :n] = h[order]
    ends = np.searchsorted(c, np.arange(len(layout.limits)))
    a = states @ np.vstack([p["class_w"], p["class_b"]])
    logs = log_softmax_at(a, c, slopes) if len(y) else np.zeros(0, h.dtype)
    if slopes:
        _add(grad, "class", slice(None), states.T @ a)
        slope = a @ p["class_w"].T
    words = np.vstack([p["word_w"], p["word_b"]])
    for k in range(len(layout.limits) - 1):
        rows, own = slice(ends[k], ends[k + 1]), slice(layout.limits[k], layout.limits[k + 1])
        if rows.start == rows.stop or own.stop - own.start < 2:
            continue
        a = states[rows] @ words[:, own]
        logs[rows] += log_softmax_at(a, y[rows] - own.start, slopes)
        if slopes:
            _add(grad, "word", own, states[rows].T @ a)
            slope[rows] += a @ p["word_w"][:, own].T
    out = np.empty_like(logs)
    out[order] = logs
    if not slopes:
        return out
    dh = np.empty_like(slope)
    dh[order] = slope
    return out, dh


def _add(grad: dict, name: str, own: slice, sums: np.ndarray) -> None:
    """Add the gradients of weights and, in the last row, of biases."""
    grad[f"{name}_w"][:, own] += sums[:-1]
    grad[f"{name}_b"][own] += sums[-1]


def lane_texts(texts: list[np.ndarray], width: int) -> list[list[int]]:
    """The texts dealt to at most ``width`` lanes of like total length, longest first.

    Equal lengths go by a checksum of the text, so the order in which texts arrive does not matter.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.lexsort((np.array([zlib.crc32(t.tobytes()) for t in texts], np.int64), -sizes))
    filled = [(0, k) for k in range(min(width, len(texts)))]
    lanes: list[list[int]] = [[] for _ in filled]
    for i in order.tolist():
        total, k = heapq.heappop(filled)
        lanes[k].append(i)
        heapq.heappush(filled, (total + int(sizes[i]), k))
    return lanes


def windows(texts: list[np.ndarray], lanes: list[list[int]], begin: int):
    """Window by window over all lanes, where one text follows another: inputs, targets, whose token a
    place is (-1: the lane has ended), and where texts begin. Lanes that have ended are left out."""
    lanes = [[i for i in lane if len(texts[i])] for lane in lanes]
    lanes = sorted((lane for lane in lanes if lane), key=lambda lane: -sum(len(texts[i]) for i in lane))
    row = [i for lane in lanes for i in lane]
    if not row:
        return
    y = np.concatenate([texts[i] for i in row]).astype(np.int64)
    lengths = np.array([len(texts[i]) for i in row])
    of, starts = np.repeat(np.array(row, np.int64), lengths), np.cumsum(lengths) - lengths
    first = np.zeros(len(y), bool)
    first[starts] = True
    x = np.where(first, begin, np.concatenate([[begin], y[:-1]]))
    sizes = np.array([sum(len(texts[i]) for i in lane) for lane in lanes])
    offsets = np.cumsum(sizes) - sizes
    for lo in range(0, int(sizes[0]), WINDOW):
        live = int((sizes > lo).sum())
        step = np.arange(lo, min(lo + WINDOW, int(sizes[0])))[:, None]
        there = step < sizes[:live]
        at = np.where(there, offsets[:live] + step, 0)
        yield np.where(there, x[at], begin), np.where(there, y[at], 0), np.where(there, of[at], -1), there & first[at]


def score(p: dict, layout: Layout, texts: list[np.ndarray], width: int = 512) -> np.ndarray:
    """Natural log-likelihood of each whole text; the state is carried from window to window."""
    of_class, out = layout.class_of(), np.zeros(len(texts))
    h = np.zeros((width, p["back"].shape[0]), np.float32)
    for x, y, of, begins in windows(texts, lane_texts(texts, width), layout.symbols):
        states = forward(p, x, begins, h[: x.shape[1]])
        of, y = of.reshape(-1), y.reshape(-1)
        there = np.flatnonzero(of >= 0)
        logs = log_likelihoods(p, layout, of_class, states.reshape(-1, h.shape[1])[there], y[there])
        out += np.bincount(of[there], logs, len(texts))
        h = states[-1]
    return out


def train(p: dict, layout: Layout, texts: list[np.ndarray], rate: float = 0.004, width: int = 256) -> tuple[dict, int]:
    """One pass of truncated backpropagation through windows, with Adam steps; new weights, tokens seen.

    A step takes a full window of all lanes. There are up to ``width`` lanes, fewer for few tokens, so
    that they make some steps at all. Where lanes have ended, windows are taken together until their
    tokens are half of a full one's, so that a long text left alone is not a step for every few tokens.
    """
    flat, p = _joined(p)
    of_class, n, seen, step = layout.class_of(), p["back"].shape[0], 0, 0
    tokens = sum(map(len, texts))
    width = int(min(width, max(MIN_LANES, tokens // (WINDOW * MIN_STEPS))))
    lanes = lane_texts(texts, width)
    (slopes, grad), held = _joined({k: np.zeros_like(v) for k, v in p.items()}), 0
    m1, m2, q = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat)
    h = np.zeros((len(lanes), n), flat.dtype)
    for x, y, of, begins in windows(texts, lanes, layout.symbols):
        kept: list = []
        states = forward(p, x, begins, h[: x.shape[1]], kept)
        h = states[-1]
        there = np.flatnonzero(of.reshape(-1) >= 0)
        _, d = log_likelihoods(p, layout, of_class, states.reshape(-1, n)[there], y.reshape(-1)[there], grad)
        outer = np.zeros_like(states)
        outer.reshape(-1, n)[there] = d
        add_rows(grad["into"], x.reshape(-1), backward(p, grad, kept, outer, begins).reshape(-1, 3 * n))
        seen, held = seen + len(there), held + len(there)
        if 2 * held < len(lanes) * WINDOW and seen < tokens:
            continue
        step += 1
        slopes *= 1 / held
        np.clip(slopes, -0.1, 0.1, out=slopes)
        m1 += np.multiply(np.subtract(slopes, m1, out=q), 0.1, out=q)
        slopes *= slopes
        m2 += np.multiply(np.subtract(slopes, m2, out=q), 0.01, out=q)
        # what is left at the end counts by its tokens
        part = min(1.0, 2 * held / (len(lanes) * WINDOW))
        np.sqrt(np.multiply(m2, 1 / (1 - 0.99**step), out=q), out=q)
        q += 1e-6
        np.divide(m1, q, out=q)
        q *= part * rate / (1 - 0.9**step)
        flat -= q
        slopes[:] = 0
        held = 0
    return {k: v.copy() for k, v in p.items()}, seen


def _joined(p: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A copy of all weights in one row, and each weight's part of that row in its own shape."""
    flat, parts, lo = np.concatenate([v.reshape(-1) for v in p.values()]), {}, 0
    for k, v in p.items():
        parts[k] = flat[lo : lo + v.size].reshape(v.shape)
        lo += v.size
    return flat, parts


def add_rows(total: np.ndarray, at: np.ndarray, rows: np.ndarray, often: int = 12) -> None:
    """Add each of ``rows`` to the row of ``total`` that ``at`` names.

    Places named more than ``often`` times are summed one by one, the others side by side: all first
    rows, all second ones, and so on.
    """
    order = np.argsort(at.astype(np.uint16 if len(total) <= 1 << 16 else np.int64), kind="stable")
    at, rows = at[order], rows[order]
    firsts = np.flatnonzero(np.diff(at, prepend=-1))
    counts = np.diff(firsts, append=len(at))
    for lo, n in zip(firsts[counts > often].tolist(), counts[counts > often].tolist(), strict=True):
        total[at[lo]] += rows[lo : lo + n].sum(0)
    few = firsts[counts <= often]
    counts = counts[counts <= often]
    for k in range(int(counts.max(initial=0))):
        own = few[counts > k] + k
        total[at[own]] += rows[own]


def backward(p: dict, grad: dict, kept: list, outer: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Gradients of what goes into each step, through the window alone; those of ``back`` are added to ``grad``."""
    (h0, z, r, new), n = kept[0], outer.shape[2]
    z_back, r_back, new_back = np.ascontiguousarray(_apart(p["back"], n).transpose(0, 2, 1))
    into = np.empty((3, *outer.shape), outer.dtype)
    # what the slope of a state is to be multiplied by, all steps at once
    by_z, by_new, by_r = (h0 - new) * z * (1 - z), (1 - z) * (1 - new * new), h0 * r * (1 - r)
    dh, fresh = np.zeros_like(outer[0]), begins.any(1)
    for s in range(len(outer) - 1, -1, -1):
        dh += outer[s]
        reset = np.multiply(dh, by_new[s], out=into[2, s]) @ new_back
        np.multiply(dh, by_z[s], out=into[0, s])
        np.multiply(reset, by_r[s], out=into[1, s])
        dh *= z[s]
        reset *= r[s]
        dh += reset
        dh += into[0, s] @ z_back
        dh += into[1, s] @ r_back
        if fresh[s]:
            dh[begins[s]] = 0
    before, flat = h0.reshape(-1, n), into.reshape(3, -1, n)
    grad["back"] += np.concatenate([before.T @ flat[0], before.T @ flat[1], (r * h0).reshape(-1, n).T @ flat[2]], 1)
    return np.concatenate(list(into), 2)
