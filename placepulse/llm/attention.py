"""A small causal self-attention model over token classes, forwards and backwards in numpy.

One head, one layer: ``h = x + softmax(q k' / sqrt(d) + mask) v W`` over the embeddings ``x`` of a window.
What comes next is predicted in two steps, a class and a member of the class, each by a softmax, so
that a token costs the sum of both sizes and not their product. Classes are the ids by frequency; the last class
holds all rarer ids and leaves the choice among them to their counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Numbers of an embedding, positions of a window, positions of it that are scored (the others are context).
WIDTH = 16
WINDOW = 32
FRESH = 24
CLASSES = 16
MEMBERS = 64


@dataclass(frozen=True)
class Ranks:
    """Ids by training count: the ``CLASSES * MEMBERS`` most frequent are predicted from the context."""

    rank: np.ndarray
    #: log of the share of an id among the rare ones; 0 for the others.
    rare: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Ranks:
        """From the count of every id; each rare id counts once more, so that none is impossible."""
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(counts), np.int64)
        rank[order] = np.arange(len(counts))
        known = CLASSES * MEMBERS
        few = rank >= known
        rare = np.zeros(len(counts))
        rare[few] = np.log((counts[few] + 1.0) / (counts[few] + 1.0).sum())
        return Ranks(np.minimum(rank, known).astype(np.int32), rare)


SHAPES = {
    "embedding": (CLASSES * MEMBERS + 1, WIDTH),
    "place": (WINDOW, WIDTH),
    "query": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH),
    "out": (WIDTH, WIDTH),
    "classes": (WIDTH, CLASSES + 1),
    "class_bias": (CLASSES + 1,),
    "members": (CLASSES, WIDTH, MEMBERS),
    "member_bias": (CLASSES, MEMBERS),
}
_SIZES = {name: math.prod(shape) for name, shape in SHAPES.items()}
SIZE = sum(_SIZES.values())
Weights = dict[str, np.ndarray]


def unpacked(flat: np.ndarray) -> Weights:
    """Views of one array, a matrix each."""
    weights, at = {}, 0
    for name, shape in SHAPES.items():
        weights[name] = flat[at : at + _SIZES[name]].reshape(shape)
        at += _SIZES[name]
    return weights


def started(counts: np.ndarray, seed: int) -> np.ndarray:
    """Weights before training: small random ones; the biases are the log counts of classes and members."""
    rng = np.random.RandomState(seed)
    flat = (rng.standard_normal(SIZE) * 0.1).astype(np.float32)
    weights = unpacked(flat)
    ordered = np.zeros(CLASSES * MEMBERS)
    most = np.sort(counts)[::-1].astype(float)
    ordered[: min(len(ordered), len(most))] = most[: len(ordered)]
    heads = (ordered + 0.5).reshape(CLASSES, MEMBERS)
    mass = np.append(heads.sum(axis=1), most[len(ordered) :].sum() + 0.5)
    weights["class_bias"][:] = np.log(mass / mass.sum())
    weights["member_bias"][:] = np.log(heads / heads.sum(axis=1, keepdims=True))
    return flat


#: Logits are held within these bounds, part of the model, so that no exponential leaves float32.
LIMIT = 60
_CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_SCALE = np.float32(WIDTH**-0.5)


def _attended(weights: Weights, inputs: np.ndarray, first: int) -> tuple:
    """States of the positions from ``first`` on, and what the way back needs. ``inputs``: windows of ranks.

    Queries and keys meet only in their product, values and the output likewise: both pairs are one matrix each.
    """
    windows, length = inputs.shape
    x = weights["embedding"].take(inputs, axis=0)
    x += weights["place"][:length]
    fresh = np.ascontiguousarray(x[:, first:]).reshape(-1, WIDTH)
    queries = (fresh @ (weights["query"] @ weights["key"].T * _SCALE)).reshape(windows, length - first, WIDTH)
    scores = np.matmul(queries, x.transpose(0, 2, 1))
    np.clip(scores, -LIMIT, LIMIT, out=scores)
    np.exp(scores, out=scores)
    # What is masked, the future, also keeps the padding behind a text out of it.
    scores *= _CAUSAL[first:length, :length]
    total = scores.reshape(-1, length) @ np.ones(length, scores.dtype)
    mixed = np.matmul(scores, x).reshape(-1, WIDTH)
    total = np.repeat(total, WIDTH).reshape(-1, WIDTH)
    mixed /= total
    states = mixed @ (weights["value"] @ weights["out"])
    states += fresh
    return states, (x, queries, scores, total, mixed)


class _Predicted:
    """States in the order of their targets' classes: all go through the softmax over classes, all but the last, rare ones through one over members."""

    def __init__(self, weights: Weights, states: np.ndarray, rows: np.ndarray, targets: np.ndarray):
        classes = (targets // MEMBERS).astype(np.int16)
        order = np.argsort(classes, kind="stable")
        self.rows, self.targets, self.classes = rows[order], targets[order], classes[order]
        self.weights, self.near = weights, states[self.rows]
        ends = np.cumsum(np.bincount(classes, minlength=CLASSES + 1)).tolist()
        self.known = ends[-2]
        self.parts = [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends[:-2]], ends[:-1], strict=True)) if b > a]

    def softmaxes(self):
        """Of classes, then of members: names of the weights, the indices in them with their rows, exponentials, their sums, and where the targets are."""
        members = self.targets[: self.known] % MEMBERS
        every = [((), slice(0, len(self.rows)))]
        for names, parts, wanted in ((("classes", "class_bias"), every, self.classes), (("members", "member_bias"), self.parts, members)):
            found = np.empty((len(wanted), self.weights[names[0]].shape[-1]), self.near.dtype)
            for c, part in parts:
                matrix, bias = (self.weights[n][c] for n in names)
                logits = np.matmul(self.near[part], matrix, out=found[part])
                logits += bias
            np.clip(found, -LIMIT, LIMIT, out=found)
            np.exp(found, out=found)
            # Sums part by part: those over other parts could differ in their last bits.
            ones, total = np.ones(found.shape[1], found.dtype), np.empty(len(found), found.dtype)
            for _, part in parts:
                np.matmul(found[part], ones, out=total[part])
            yield names, parts, found, total, (np.arange(len(found)), wanted)


def log_likelihoods(weights: Weights, inputs: np.ndarray, targets: np.ndarray, first: int) -> np.ndarray:
    """Natural log of the probability of every target; ``targets`` are those of the positions from ``first`` on."""
    states, _ = _attended(weights, inputs, first)
    predicted = _Predicted(weights, states, np.arange(len(states)), targets.ravel())
    found = np.zeros(len(states), states.dtype)
    for _, _, shares, total, at in predicted.softmaxes():
        found[: len(shares)] += np.log(shares[at] / total + 1e-30)
    out = np.empty_like(found)
    out[predicted.rows] = found
    return out.reshape(targets.shape)


def gradient(weights: Weights, inputs: np.ndarray, targets: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the mean negative log likelihood of the targets that are ``there``, flat, and that mean."""
    states, (x, queries, scores, total, mixed) = _attended(weights, inputs, 0)
    flat = np.zeros(SIZE, np.float32)
    out = unpacked(flat)
    rows = np.flatnonzero(there.ravel())
    predicted = _Predicted(weights, states, rows, targets.ravel()[rows])
    n, loss = np.float32(max(1, len(rows))), 0.0
    back = np.zeros_like(predicted.near)
    for (matrix, bias), parts, shares, sums, at in predicted.softmaxes():
        wanted = shares[at]
        loss -= np.log(wanted / sums + 1e-30).sum()
        # Less what was wanted; divided by the sums where that is narrow.
        shares[at] = wanted - sums
        scale = 1 / (sums * n)
        # Made as wide as a state, once, since narrow rows are slow to spread one number over.
        wide = np.repeat(scale, WIDTH).reshape(-1, WIDTH)
        near = predicted.near[: len(shares)] * wide
        felt = np.empty_like(near)
        for c, part in parts:
            out[matrix][c], out[bias][c] = near[part].T @ shares[part], scale[part] @ shares[part]
            np.matmul(shares[part], weights[matrix][c].T, out=felt[part])
        felt *= wide
        back[: len(felt)] += felt
    d_states = np.zeros_like(states)
    d_states[predicted.rows] = back
    d_joint = mixed.T @ d_states
    out["value"][:], out["out"][:] = d_joint @ weights["out"].T, weights["value"].T @ d_joint
    d_mixed = d_states @ (weights["value"] @ weights["out"]).T
    d_mixed /= total
    common = np.einsum("ij,ij->i", d_mixed, mixed).reshape(*inputs.shape, 1)
    d_mixed = d_mixed.reshape(x.shape)
    d_scores = np.matmul(d_mixed, x.transpose(0, 2, 1))
    d_scores -= common
    d_scores *= scores
    d_x = np.matmul(scores.transpose(0, 2, 1), d_mixed)
    d_x += np.matmul(d_scores.transpose(0, 2, 1), queries)
    d_x = d_x.reshape(-1, WIDTH)
    d_x += d_states
    d_queries = np.matmul(d_scores, x).reshape(-1, WIDTH)
    d_x += d_queries @ (weights["key"] @ weights["query"].T * _SCALE)
    d_joint = x.reshape(-1, WIDTH).T @ d_queries * _SCALE
    out["query"][:], out["key"][:] = d_joint @ weights["key"], d_joint.T @ weights["query"]
    out["place"][: x.shape[1]] = (np.ones(len(x), d_x.dtype) @ d_x.reshape(len(x), -1)).reshape(x.shape[1:])
    ids = inputs.ravel().astype(np.intp)
    for k in range(WIDTH):
        out["embedding"][:, k] = np.bincount(ids, d_x[:, k], len(out["embedding"]))
    return flat, float(loss / n)


@dataclass
class Adam:
    """Step sizes by the running moments of the gradient."""

    rate: float
    first: np.ndarray | None = None
    second: np.ndarray | None = None
    turn: int = 0

    def step(self, flat: np.ndarray, grad: np.ndarray) -> None:
        if not self.turn:
            self.first, self.second = np.zeros_like(grad), np.zeros_like(grad)
        self.turn += 1
        self.first *= 0.9
        self.first += 0.1 * grad
        self.second *= 0.98
        self.second += 0.02 * grad * grad
        change = self.first * (self.rate / (1 - 0.9**self.turn))
        size = np.sqrt(self.second / (1 - 0.98**self.turn))
        size += 1e-7
        change /= size
        flat -= change


def windows(ranks: np.ndarray, sizes: np.ndarray, start: int, length: int, step: int) -> tuple[np.ndarray, ...]:
    """Inputs and targets of texts cut into windows, which targets count, each once, and each window's text and place in it.

    ``ranks`` are those of ``sizes`` texts, each with its end; its predecessors are led by ``start``. A window begins
    ``step`` positions after the one before; of all but the first only the last ``step`` positions count.
    """
    count = 1 + np.maximum(0, -(-(sizes - length) // step))
    # Every text takes its windows' positions and one more, filled up with ``start``.
    room = (count - 1) * step + length + 1
    before = np.cumsum(room) - room
    padded = np.full(int(room.sum()), start, np.int32)
    padded[np.arange(len(ranks)) + np.repeat(before + 1 - (np.cumsum(sizes) - sizes), sizes)] = ranks
    of = np.repeat(np.arange(len(sizes)), count)
    turn = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    begun = before[of] + turn * step
    spans = np.lib.stride_tricks.sliding_window_view(padded, length)
    left = (sizes[of] - turn * step)[:, None]
    counts = (np.arange(length) < left) & ((turn == 0)[:, None] | (np.arange(length) >= length - step))
    return spans[begun], spans[begun + 1], counts, of, turn
