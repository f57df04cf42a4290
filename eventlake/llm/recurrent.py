"""A gated recurrent language model in numpy with a class-factored output softmax.

A symbol is a frequent word or a class of all other words. Output: first the class of the next
symbol, then, in classes of frequent words, the word. Many texts run side by side in lanes, window
after window; a lane keeps its state from window to window until its text ends, so a text of any
length is scored whole with a bounded amount of memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np

NAMES = ("inputs", "gates", "candidate", "class_weights", "class_bias", "word_weights", "word_bias")


@dataclass(frozen=True)
class Layout:
    """Symbols 0 .. words-1 are frequent words in the order of their classes, then come tail classes."""

    words: int
    class_starts: np.ndarray  # first word of every word class
    tails: int
    end: int  # the symbol that ends a text

    @property
    def classes(self) -> int:
        return len(self.class_starts) + self.tails

    @property
    def symbols(self) -> int:
        return self.words + self.tails

    def class_of(self) -> np.ndarray:
        sizes = np.diff(np.append(self.class_starts, self.words))
        own = np.concatenate([np.repeat(np.arange(len(sizes)), sizes), np.arange(len(sizes), self.classes)])
        return own.astype(np.min_scalar_type(self.classes))  # small numbers are sorted by counting


@dataclass
class Network:
    layout: Layout
    inputs: np.ndarray  # symbols x 3 hidden: what a symbol adds to update gate, reset gate, candidate
    gates: np.ndarray  # hidden x 2 hidden
    candidate: np.ndarray  # hidden x hidden
    class_weights: np.ndarray
    class_bias: np.ndarray
    word_weights: np.ndarray
    word_bias: np.ndarray

    @property
    def hidden(self) -> int:
        return len(self.gates)

    def copy(self) -> Network:
        return replace(self, **{n: getattr(self, n).copy() for n in NAMES})

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in NAMES])

    def with_flat(self, values: np.ndarray) -> Network:
        parts, at = {}, 0
        for n in NAMES:
            old = getattr(self, n)
            parts[n] = values[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size
        return replace(self, **parts)


def start(layout: Layout, counts: np.ndarray, hidden: int, seed: int) -> Network:
    """A network whose first guess is the frequency of every symbol."""
    rng = np.random.default_rng(seed)
    own = layout.class_of()
    share = np.log(counts + 1.0)
    totals = np.bincount(own, weights=counts, minlength=layout.classes)

    def random(*shape):
        return rng.normal(0, 0.1, shape).astype(np.float32)

    inputs = random(layout.symbols, 3 * hidden)
    inputs[:, :hidden] -= 1.0  # slow to forget
    return Network(
        layout, inputs, random(hidden, 2 * hidden), random(hidden, hidden),
        random(layout.classes, hidden) * 0.1, np.log(totals + 1.0).astype(np.float32),
        random(layout.words, hidden) * 0.1, share[: layout.words].astype(np.float32),
    )


class Lanes:
    """Texts in lanes: `add` deals texts out, `windows` gives matrices of (input, output, text, first)."""

    def __init__(self, count: int, window: int, end: int):
        self.count, self.window, self.end = count, window, end
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(count)]
        self.held = np.zeros(count, np.int64)

    def add(self, texts: Iterator[tuple[int, np.ndarray]]) -> None:
        """Texts are symbols with the end; each goes to the lane with the least to do."""
        ordered = sorted(texts, key=lambda t: -len(t[1]))
        if not ordered:
            return
        sizes = np.array([len(symbols) for _, symbols in ordered])
        ends = np.cumsum(sizes)
        begins = ends - sizes
        block = np.zeros((4, int(ends[-1])), np.int32)
        np.concatenate([symbols for _, symbols in ordered], out=block[1], casting="same_kind")
        block[0, 1:] = block[1, :-1]
        block[0, begins], block[3, begins] = self.end, 1
        block[2] = np.repeat([number for number, _ in ordered], sizes)
        for begin, end in zip(begins.tolist(), ends.tolist()):
            lane = int(self.held.argmin())
            self.waiting[lane].append(block[:, begin:end])
            self.held[lane] += end - begin

    def windows(self, all_of_them: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(lanes in use, 4 x steps x lanes); without all_of_them only while most lanes are full."""
        # lane after lane, and last what stands where a lane has run out: nothing to score
        flat = np.concatenate([*(block for w in self.waiting for block in w), np.array([[self.end], [-1], [-1], [1]], np.int32)], axis=1)
        base = np.cumsum(self.held) - self.held
        at = np.zeros(self.count, np.int64)
        while (left := np.maximum(self.held - at, 0)).any():
            full = left >= self.window
            if not all_of_them and full.sum() < 0.75 * self.count:
                break
            steps = self.window if full.any() else int(left.max())
            used = np.flatnonzero(left > 0)
            step = np.arange(steps)[:, None]
            places = np.where(step < left[used], base[used] + at[used] + step, flat.shape[1] - 1)
            at[used] += steps
            yield used, np.take(flat, places, axis=1)
        at = np.minimum(at, self.held)
        self.waiting = [[flat[:, b + a : b + h].copy()] if h > a else [] for b, a, h in zip(base, at, self.held)]
        self.held = self.held - at


def run(net: Network, inputs: np.ndarray, first: np.ndarray, state: np.ndarray, keep: bool = False):
    """States after every step, from steps x lanes inputs; with `keep` also what gradients need.

    Update gate, reset gate and candidate of a step each are a lanes x hidden block of memory, like the
    state, so nothing is turned over. The logistic function takes one exponential, and tanh x is
    2 logistic(2 x) - 1.
    """
    hidden, (steps, lanes) = net.hidden, inputs.shape
    table, places = net.inputs.reshape(-1, hidden), inputs[:, None] * 3 + np.arange(3)[:, None]
    gates = np.ascontiguousarray(-net.gates.reshape(hidden, 2, hidden).transpose(1, 0, 2))
    candidate = -2 * net.candidate
    one, two = np.float32(1), np.float32(2)
    states = np.empty((steps, lanes, hidden), np.float32)
    held = steps if keep else 1
    x, resets = np.empty((held, 3, lanes, hidden), table.dtype), np.empty((held, lanes, hidden), table.dtype)
    by_gates, by_candidate = np.empty((2, lanes, hidden), table.dtype), np.empty((lanes, hidden), table.dtype)
    going = (1 - first).astype(np.float32)[:, :, None]
    begins = first.any(axis=1).tolist()
    h = state
    with np.errstate(over="ignore"):  # the logistic function is then 0, as it should be
        for t in range(steps):
            if begins[t]:
                h = h * going[t]
            own = np.take(table, places[t], axis=0, out=x[t % held], mode="clip")
            both, c = own[:2], own[2]
            np.subtract(np.matmul(h, gates, out=by_gates), both, out=both)
            np.exp(both, out=both)
            both += one
            np.reciprocal(both, out=both)
            rh = np.multiply(both[1], h, out=resets[t % held])
            c += c
            np.subtract(np.matmul(rh, candidate, out=by_candidate), c, out=c)
            np.exp(c, out=c)
            c += one
            np.divide(two, c, out=c)
            c -= one
            new = np.subtract(c, h, out=states[t])
            new *= both[0]
            new += h
            h = new
    if not keep:
        return states, None, going
    before = np.concatenate([state[None], states[:-1]])
    before *= going
    return states, (before, x[:, 0], x[:, 1], resets, x[:, 2]), going


def log_probs(net: Network, states: np.ndarray, outputs: np.ndarray, own: np.ndarray, gradients: dict | None = None, per: int = 1) -> np.ndarray:
    """Natural log probability of every output symbol; fills `gradients` of the loss / `per` if given.

    Outputs are put in the order of their classes, so a class is a slice. Every exponential is taken once:
    the gradient is what the probability is made of. Logits are laid out with the outputs last, so what
    belongs to an output is multiplied along whole rows.
    """
    n, words = len(outputs), net.layout.words
    kind = own[outputs]
    order = np.argsort(kind, kind="stable")
    outputs, kind = outputs[order], kind[order]
    s = np.take(states, order, axis=0)
    bounds = np.append(net.layout.class_starts, words)
    ends = np.searchsorted(kind, np.arange(len(bounds), dtype=kind.dtype))
    sizes = np.diff(ends)
    every, listed = np.arange(n), ends[-1]  # those of word classes come first
    # where a class's logits, row after row, hold that of the wanted word
    within = kind[:listed]
    wanted = (outputs[:listed] - bounds[within]) * sizes[within] + every[:listed] - ends[within]
    # what each output's class, and its word in the class, add up to, and their logits
    sums, chosen = np.ones((2, n), states.dtype), np.zeros((2, n), states.dtype)
    parts = [(0, slice(0, n), net.class_weights, net.class_bias[:, None], kind * np.int64(n) + every, None)]
    for a, b, low, high in zip(bounds.tolist(), bounds[1:].tolist(), ends.tolist(), ends[1:].tolist()):
        if low < high and b - a > 1:
            parts.append((1, slice(low, high), net.word_weights[a:b], net.word_bias[a:b, None], wanted[low:high], slice(a, b)))
    ones, each = np.ones(max(n, words, net.layout.classes), states.dtype), np.float32(1 / per)
    # logits lie close together as a rule: then every exponential is in range as it is
    for shifted in (False, True):
        if gradients is not None:
            word_slope, word_bias = np.zeros_like(net.word_weights), np.zeros_like(net.word_bias)
        with np.errstate(**({} if shifted else {"over": "ignore", "invalid": "ignore", "divide": "ignore"})):
            for level, rows, weights, bias, at, slots in parts:
                own_states = s[rows]
                x = weights @ own_states.T
                x += bias
                if shifted:
                    x -= x.max(axis=0)
                flat = x.reshape(-1)
                chosen[level, rows] = flat[at]
                np.exp(x, out=x)
                total = np.matmul(ones[: len(x)], x, out=sums[level, rows])
                if gradients is None:
                    continue
                x *= each / total
                flat[at] -= each
                if slots is None:
                    class_slope, class_bias, back = x @ own_states, x @ ones[:n], x.T @ weights
                else:
                    np.matmul(x, own_states, out=word_slope[slots])
                    np.matmul(x, ones[: x.shape[1]], out=word_bias[slots])
                    back[rows] += x.T @ weights
        if sums.min() > 1e-25 and sums.max() < 1e30:
            break
    out = np.empty(n)
    out[order] = (chosen - np.log(sums)).sum(axis=0, dtype=np.float64)
    if gradients is not None:
        gradients |= {"class_weights": class_slope, "class_bias": class_bias, "word_weights": word_slope, "word_bias": word_bias}
        gradients["states"] = np.empty_like(s)
        gradients["states"][order] = back
    return out


class Trainer:
    """Truncated backpropagation: gradients stop at the window's beginning, the state does not.

    Long texts are dealt out in stretches, all of which are trained on; a stretch begins without a state. So
    no lane goes on with one long text when the others have run out.
    """

    def __init__(self, net: Network, lanes: int, window: int, rate: float, stretch: int = 1024):
        self.net, self.rate, self.stretch = net, rate, stretch
        self.lanes = Lanes(lanes, window, net.layout.end)
        self.state = np.zeros((lanes, net.hidden), np.float32)
        self.squares = {n: np.full_like(getattr(net, n), 1e-4) for n in NAMES}
        self.own = net.layout.class_of()
        self.tokens, self.loss = 0, 0.0

    def feed(self, texts: Iterator[np.ndarray], last: bool = False) -> None:
        parts = (t[i : i + self.stretch] for t in texts for i in range(0, len(t), self.stretch))
        self.lanes.add((i, t) for i, t in enumerate(parts))
        for used, made in self.lanes.windows(last):
            self._step(used, made)

    def _step(self, used: np.ndarray, made: np.ndarray) -> None:
        net, hidden = self.net, self.net.hidden
        inputs, outputs, _, first = made
        states, kept, going = run(net, inputs, first, self.state[used], keep=True)
        self.state[used] = states[-1]
        real = np.flatnonzero(outputs.ravel() >= 0)
        grads: dict[str, np.ndarray] = {}
        found = log_probs(net, states.reshape(-1, hidden)[real], outputs.ravel()[real], self.own, grads, self.lanes.count * self.lanes.window)
        self.tokens += len(real)
        self.loss -= found.sum()
        outer = np.zeros((inputs.size, hidden), np.float32)
        outer[real] = grads.pop("states")
        outer = outer.reshape(states.shape)
        # by what a step multiplies the gradient of its state, for all steps at once
        before, z, r, rh, c = kept
        stay = 1 - z
        by_candidate = (1 - c * c) * z
        by_update = (c - before) * z * stay
        by_reset = before * r * (1 - r)
        dx = np.empty((3, *states.shape), np.float32)
        dh = np.zeros((inputs.shape[1], hidden), np.float32)
        gates, candidate = np.ascontiguousarray(net.gates.reshape(hidden, 2, hidden).transpose(1, 2, 0)), np.ascontiguousarray(net.candidate.T)
        begins = first.any(axis=1).tolist()
        for t in range(len(inputs) - 1, -1, -1):
            dh += outer[t]
            dc = np.multiply(dh, by_candidate[t], out=dx[2, t])
            drh = dc @ candidate
            np.multiply(dh, by_update[t], out=dx[0, t])
            np.multiply(drh, by_reset[t], out=dx[1, t])
            dh *= stay[t]
            drh *= r[t]
            dh += drh
            for by_gate in dx[:2, t] @ gates:
                dh += by_gate
            if begins[t]:
                dh *= going[t]
        # sums over all steps at once
        dx = dx.reshape(3, -1, hidden)
        was = before.reshape(-1, hidden).T
        grads["gates"] = np.concatenate([was @ dx[0], was @ dx[1]], axis=1)
        grads["candidate"] = rh.reshape(-1, hidden).T @ dx[2]
        flat = inputs.ravel().astype(np.min_scalar_type(net.layout.symbols))
        order = np.argsort(flat, kind="stable")
        listed = flat[order]
        begins = np.flatnonzero(np.append(True, listed[1:] != listed[:-1]))
        rows = listed[begins]
        pair = np.complex64 if hidden % 2 == 0 else np.float32  # two numbers are added at a time
        summed = [np.add.reduceat(np.take(part, order, axis=0).view(pair), begins, axis=0).view(np.float32) for part in dx]
        summed = np.concatenate(summed, axis=1)
        squares = self.squares["inputs"][rows] + summed * summed
        self.squares["inputs"][rows] = squares
        net.inputs[rows] -= np.float32(self.rate) * summed / np.sqrt(squares + np.float32(1e-12))
        for n, g in grads.items():
            self.squares[n] += g * g
            getattr(net, n)[...] -= np.float32(self.rate) * g / np.sqrt(self.squares[n])


class Scorer:
    """Adds up the log probabilities of whole texts as they pass through the lanes."""

    def __init__(self, net: Network, lanes: int, window: int):
        self.net = net
        self.lanes = Lanes(lanes, window, net.layout.end)
        self.state = np.zeros((lanes, net.hidden), np.float32)
        self.own = net.layout.class_of()
        self.sums: dict[int, float] = {}
        self.left: dict[int, int] = {}

    def feed(self, texts: list[tuple[int, np.ndarray]], last: bool = False) -> list[tuple[int, float]]:
        """Take texts; give (number, natural log probability) of those that are complete now."""
        self.left.update((i, len(t)) for i, t in texts)
        self.sums.update((i, 0.0) for i, _ in texts)
        self.lanes.add(iter(texts))
        done = []
        for used, made in self.lanes.windows(last):
            inputs, outputs, number, first = made
            states, _, _ = run(self.net, inputs, first, self.state[used])
            self.state[used] = states[-1]
            real = np.flatnonzero(outputs.ravel() >= 0)
            logs = np.zeros(inputs.size)
            logs[real] = log_probs(self.net, states.reshape(-1, self.net.hidden)[real], outputs.ravel()[real], self.own)
            # a text stands in one lane without a gap
            logs, which = (m.reshape(inputs.shape).T.ravel() for m in (logs, number))
            begins = np.flatnonzero(np.append(True, which[1:] != which[:-1]))
            lengths = np.diff(np.append(begins, len(which)))
            for i, total, n in zip(which[begins].tolist(), np.add.reduceat(logs, begins).tolist(), lengths.tolist()):
                if i < 0:
                    continue
                self.sums[i] += total
                self.left[i] -= n
                if not self.left[i]:
                    done.append((i, self.sums.pop(i)))
                    del self.left[i]
        return done
