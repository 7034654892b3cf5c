"""A gated recurrent language model in numpy: class-factored softmax, truncated backpropagation.

Word ids: 0 is the end of a document, then the other common words, by falling count; after them one
id per class of rare words. The first ``common // width`` classes hold ``width`` common words each, the others the rare words.
The model gives the probability of the class and, for common words, of the word inside it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np

END = 0


@dataclass
class Shape:
    common: int = 2048
    width: int = 64
    rare: int = 32
    hidden: int = 24
    lanes: int = 256
    steps: int = 32

    @property
    def common_classes(self) -> int:
        return self.common // self.width

    @property
    def classes(self) -> int:
        return self.common_classes + self.rare

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.common, ids // self.width, self.common_classes + ids - self.common)


Weights = dict[str, np.ndarray]


def start_weights(shape: Shape, counts: np.ndarray, seed: int = 0) -> Weights:
    """Small random weights, and biases that make the first predictions those of the counts of the ids."""
    rng = np.random.default_rng(seed)
    h = shape.hidden

    def normal(*size: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(size) * scale).astype(np.float32)

    by_class = np.bincount(shape.class_of(np.arange(len(counts))), counts + 1.0, minlength=shape.classes)
    inputs = normal(len(counts), 3 * h, scale=0.3)
    inputs[:, :h] -= 1.0
    return {
        "inputs": inputs,
        "state": normal(h, 3 * h, scale=1 / np.sqrt(h)),
        "class": normal(h, shape.classes, scale=0.05),
        "class_bias": np.log(by_class / by_class.sum()).astype(np.float32),
        "word": normal(shape.common, h, scale=0.05),
        "word_bias": np.log(counts[: shape.common] + 1.0).astype(np.float32),
    }


def lanes_of(lengths: np.ndarray, lanes: int) -> list[list[int]]:
    """Sequences dealt over lanes so that the longest lane is short: longest first, to the emptiest lane."""
    queue = [(0, i) for i in range(max(1, min(lanes, len(lengths))))]
    dealt: list[list[int]] = [[] for _ in queue]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        filled, lane = heapq.heappop(queue)
        dealt[lane].append(doc)
        heapq.heappush(queue, (filled + int(lengths[doc]), lane))
    return dealt


def streams(docs: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (step, lane), -1 past a lane's end, and the document of each; a document's ids end with END."""
    dealt = lanes_of(np.fromiter(map(len, docs), np.int64, len(docs)), lanes)
    height = max(sum(len(docs[d]) for d in lane) for lane in dealt)
    ids = np.full((height, len(dealt)), -1, np.int32)
    owner = np.full((height, len(dealt)), -1, np.int32)
    for j, lane in enumerate(dealt):
        if lane:
            row = np.concatenate([docs[d] for d in lane])
            ids[: len(row), j] = row
            owner[: len(row), j] = np.repeat(lane, [len(docs[d]) for d in lane])
    return ids, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(np.clip(x, -60, 60, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def forward(w: Weights, before: np.ndarray, state: np.ndarray, keep: bool = False):
    """States after each step, from the ids before each step; a document starts from state 0.

    before: (steps, lanes). Returns the states (steps, lanes, hidden), and what the gradient needs with ``keep``.
    """
    h = state.shape[1]
    out = np.empty((*before.shape, h), np.float32)
    traces = []
    for t, ids in enumerate(before):
        state = state * (ids != END)[:, None]
        x = w["inputs"][np.maximum(ids, 0)]
        u = state @ w["state"]
        gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        n = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
        new = n + z * (state - n)
        if keep:
            traces.append((state, z, r, n, u[:, 2 * h :]))
        state = out[t] = new
    return out, state, traces


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def _picked(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-softmax of each row at one place; overwrites ``x``."""
    x -= x.max(axis=1, keepdims=True)
    chosen = x[np.arange(len(at)), at]
    return chosen - np.log(np.exp(x, out=x).sum(axis=1))


def log_probabilities(w: Weights, shape: Shape, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log-probability of each id (of its class only, where it is a rare class) after each state."""
    classes = shape.class_of(ids)
    out = _picked(states @ w["class"] + w["class_bias"], classes).astype(np.float64)
    order = np.argsort(classes, kind="stable")
    ends = np.searchsorted(classes[order], np.arange(shape.common_classes + 1))
    for c in range(shape.common_classes):
        at = order[ends[c] : ends[c + 1]]
        if len(at):
            words = slice(c * shape.width, (c + 1) * shape.width)
            logits = states[at] @ w["word"][words].T + w["word_bias"][words]
            out[at] += _picked(logits, ids[at] - c * shape.width)
    return out


def score(w: Weights, shape: Shape, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each whole document; the state is carried from window to window."""
    totals = np.zeros(len(docs))
    if not docs:
        return totals
    ids, owner = streams(docs, shape.lanes)
    state = np.zeros((ids.shape[1], shape.hidden), np.float32)
    last = np.full((1, ids.shape[1]), END, np.int32)
    for t in range(0, len(ids), shape.steps):
        window = ids[t : t + shape.steps]
        before = np.concatenate([last, window[:-1]])
        states, state, _ = forward(w, before, state)
        real = window >= 0
        gained = log_probabilities(w, shape, states[real], window[real])
        totals += np.bincount(owner[t : t + shape.steps][real], gained, minlength=len(docs))
        last = window[-1:]
        if not real[-1].all():
            # Lanes that are through leave.
            live = real[-1]
            ids, owner, state, last = ids[:, live], owner[:, live], state[live], last[:, live]
            if not live.any():
                break
    return totals


def gradient(w: Weights, shape: Shape, before: np.ndarray, ids: np.ndarray, state: np.ndarray):
    """Loss per id, gradient over one window, and the state after it; the window's first state is a constant."""
    steps, lanes = ids.shape
    h = shape.hidden
    states, after, traces = forward(w, before, state, keep=True)
    real = ids >= 0
    n = max(1, int(real.sum()))
    s, y = states[real], ids[real]
    g: Weights = {k: np.zeros_like(v) for k, v in w.items()}
    classes = shape.class_of(y)
    logp = _log_softmax(s @ w["class"] + w["class_bias"])
    loss = -float(logp[np.arange(len(y)), classes].sum())
    d = np.exp(logp)
    d[np.arange(len(y)), classes] -= 1
    d /= n
    g["class"] = s.T @ d
    g["class_bias"] = d.sum(axis=0)
    ds = d @ w["class"].T
    order = np.argsort(classes, kind="stable")
    ends = np.searchsorted(classes[order], np.arange(shape.common_classes + 1))
    for c in range(shape.common_classes):
        at = order[ends[c] : ends[c + 1]]
        if len(at):
            words = slice(c * shape.width, (c + 1) * shape.width)
            logp = _log_softmax(s[at] @ w["word"][words].T + w["word_bias"][words])
            own = y[at] - c * shape.width
            loss -= float(logp[np.arange(len(at)), own].sum())
            d = np.exp(logp)
            d[np.arange(len(at)), own] -= 1
            d /= n
            g["word"][words] = d.T @ s[at]
            g["word_bias"][words] = d.sum(axis=0)
            ds[at] += d @ w["word"][words]
    at_states = np.zeros_like(states)
    at_states[real] = ds
    flow = np.zeros((lanes, h), np.float32)
    inputs = np.empty((steps, lanes, 3 * h), np.float32)
    for t in range(steps - 1, -1, -1):
        prior, z, r, cand, un = traces[t]
        flow = flow + at_states[t]
        dn = flow * (1 - z) * (1 - cand * cand)
        dz = flow * (prior - cand) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        to_state = np.concatenate([dz, dr, dn * r], axis=1)
        inputs[t] = np.concatenate([dz, dr, dn], axis=1)
        g["state"] += prior.T @ to_state
        flow = (flow * z + to_state @ w["state"].T) * (before[t] != END)[:, None]
    flat = np.maximum(before, 0).ravel()
    order = np.argsort(flat, kind="stable")
    firsts = np.flatnonzero(np.concatenate([[True], np.diff(flat[order]) > 0]))
    g["inputs"][flat[order][firsts]] = np.add.reduceat(inputs.reshape(-1, 3 * h)[order], firsts, axis=0)
    return loss / n, g, after


@dataclass
class Adam:
    """Steps of a size that falls linearly to a tenth over ``total`` steps."""

    rate: float
    total: int
    done: int = 0
    first: Weights = field(default_factory=dict)
    second: Weights = field(default_factory=dict)

    def step(self, w: Weights, g: Weights) -> None:
        self.done += 1
        size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        scale = min(1.0, 5.0 / max(size, 1e-12))
        rate = self.rate * max(0.1, 1 - 0.9 * self.done / max(1, self.total))
        for k, x in g.items():
            x = x * scale
            m = self.first[k] = 0.9 * self.first.get(k, 0.0) + 0.1 * x
            v = self.second[k] = 0.99 * self.second.get(k, 0.0) + 0.01 * x * x
            w[k] -= rate * (m / (1 - 0.9**self.done)) / (np.sqrt(v / (1 - 0.99**self.done)) + 1e-6)


def train(w: Weights, shape: Shape, docs: list[np.ndarray], rate: float, every: int, phase: int) -> int:
    """One pass over the documents, changing ``w``: windows ``phase, phase + every, ...`` of the streams are learnt from.

    With ``every`` 1 each window starts from the state after the one before it; otherwise from the state carried through one
    window before it. Returns the number of ids learnt from.
    """
    if not docs:
        return 0
    ids, _ = streams(docs, shape.lanes)
    starts = list(range(phase * shape.steps, len(ids), every * shape.steps)) or [0]
    optimizer = Adam(rate, len(starts))
    learnt, carried = 0, np.zeros((ids.shape[1], shape.hidden), np.float32)
    for t in starts:
        window = ids[t : t + shape.steps]
        live = window[0] >= 0
        if not live.any():
            break
        window = window[:, live]
        state = np.zeros((window.shape[1], shape.hidden), np.float32)
        last = np.full((1, window.shape[1]), END, np.int32)
        if t and every == 1:
            state, last = carried[live], ids[t - 1][None, live]
        elif t:
            prior = ids[max(0, t - shape.steps) : t][:, live]
            lead = np.concatenate([np.full_like(prior[:1], END) if t <= shape.steps else ids[t - shape.steps - 1][None, live], prior[:-1]])
            _, state, _ = forward(w, lead, state)
            last = prior[-1:]
        _, g, carried[live] = gradient(w, shape, np.concatenate([last, window[:-1]]), window, state)
        optimizer.step(w, g)
        learnt += int((window >= 0).sum())
    return learnt
