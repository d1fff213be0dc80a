"""A gated recurrent network with a class-factored softmax, in numpy.

Hidden states and slopes are held by step, then feature, then stream (or document), so that a
step's operations run over contiguous values, and what does not depend on the step before is
worked out for a whole window. Arrays of a window are used again for the next.
"""

from __future__ import annotations

import numpy as np

HIDDEN, CLASS_WORDS, WINDOW = 32, 64, 32
STREAMS, EPOCHS, RATE, CLIP = 32, 2, 0.01, 1.0
TOGETHER = 512  # documents scored together
AHEAD = 64  # windows of training laid out at once


SAFE = 80.0  # exp of less is finite in single precision


def _bound(weights: np.ndarray, bias: np.ndarray) -> float:
    """No logit of these rows of weights and states within -1 to 1 is larger."""
    return float((np.abs(weights).sum(1) + bias).max()) if len(bias) else 0.0


def _exponents(x: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Exponents of columns in place, less their largest value where they need it, and their sums."""
    if bound > SAFE:
        x -= x.max(0)
    np.exp(x, out=x)
    return x, x.sum(0)


def _flow(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents end to end, and where each begins."""
    return np.concatenate(docs), np.cumsum([0, *map(len, docs[:-1])])


class Memory:
    """Running moments of the slopes, of one task's training, and room for a window."""

    def __init__(self, network: Network):
        self.first = {k: np.zeros_like(v) for k, v in network.weights.items()}
        self.second = {k: np.zeros_like(v) for k, v in network.weights.items()}
        self.slopes = {k: np.zeros_like(v) for k, v in network.weights.items()}
        self.change = {k: np.empty_like(v) for k, v in network.weights.items()}
        self.rounds = 0
        self._room: dict[str, np.ndarray] = {}

    def room(self, name: str, *shape: int) -> np.ndarray:
        """An array without set values, the same memory for each use of a name."""
        size = int(np.prod(shape))
        if name not in self._room or len(self._room[name]) < size:
            self._room[name] = np.empty(size, np.float32)
        return self._room[name][:size].reshape(shape)


class Network:
    """Predicts the next symbol from all before it.

    Symbols 0 .. words - 1 are words by falling frequency, `words` stands for every other
    token. Word w is in class w // CLASS_WORDS; the others are the last class, within
    which the network predicts nothing. Input words + 1 begins a document.
    """

    def __init__(self, words: int):
        rng = np.random.default_rng(7)
        self.words = words
        self.classes = -(-words // CLASS_WORDS) + 1
        draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.weights = {
            "inputs": draw(words + 2, 3 * HIDDEN),
            "state": draw(HIDDEN, 3 * HIDDEN),
            "class": draw(HIDDEN, self.classes),
            "class_bias": np.zeros(self.classes, np.float32),
            "word": draw(self.classes * CLASS_WORDS, HIDDEN),
            "word_bias": np.zeros(self.classes * CLASS_WORDS, np.float32),
        }
        # places of the last real class that no word holds
        self.weights["word_bias"][words:] = -1e4

    def copy(self) -> Network:
        other = Network(self.words)
        other.weights = {k: v.copy() for k, v in self.weights.items()}
        return other

    def _turned(self) -> np.ndarray:
        """Weights of the state for _step: by output, those of the gates with their signs changed."""
        state = np.ascontiguousarray(self.weights["state"].T)
        state[: 2 * HIDDEN] *= -1
        return state

    @staticmethod
    def _step(x: np.ndarray, h: np.ndarray, turned: np.ndarray, shares: np.ndarray, n: np.ndarray, out: np.ndarray) -> None:
        """The next state; `shares` takes the gates and the state's share of the new value, `n` the new value."""
        np.matmul(turned, h, out=shares)
        gates = shares[: 2 * HIDDEN]
        gates -= x[: 2 * HIDDEN]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[HIDDEN:], shares[2 * HIDDEN :], out=n)
        n += x[2 * HIDDEN :]
        np.tanh(n, out=n)
        np.subtract(h, n, out=out)
        out *= gates[:HIDDEN]
        out += n

    def _kinds(self, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]]]:
        """Class of each target, targets in order of class, and each class of words with its stretch of that order."""
        kind = targets // CLASS_WORDS
        kind[targets >= self.words] = self.classes - 1
        order = np.argsort(kind.astype(np.int16), kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=self.classes)).tolist()
        return kind, order, [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends[:-2]], ends[:-1], strict=True)) if a < b]

    def log_probabilities(self, hidden: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of each target's probability, given states by feature; of its class only for other tokens."""
        w = self.weights
        kind, order, groups = self._kinds(targets)
        logits = w["class"].T @ hidden + w["class_bias"][:, None]
        logits -= logits.max(0)
        out = logits[kind, np.arange(len(targets))]
        np.exp(logits, out=logits)
        out -= np.log(logits.sum(0))
        hidden, targets, logs = hidden[:, order], targets[order], np.zeros(len(targets), np.float32)
        for c, some in groups:
            span = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
            logits = w["word"][span] @ hidden[:, some] + w["word_bias"][span][:, None]
            logits -= logits.max(0)
            logs[some] = logits[targets[some] - c * CLASS_WORDS, np.arange(some.stop - some.start)]
            np.exp(logits, out=logits)
            logs[some] -= np.log(logits.sum(0))
        out[order] += logs
        return out

    def _output_slopes(self, hidden: np.ndarray, targets: np.ndarray, real: np.ndarray, slopes: dict) -> np.ndarray:
        """Slopes of the states, by feature; those of the output weights are added to `slopes`."""
        w = self.weights
        kind, order, groups = self._kinds(targets)
        scale = real.astype(np.float32) / max(1, real.sum())
        off, sums = _exponents(w["class"].T @ hidden + w["class_bias"][:, None], _bound(w["class"].T, w["class_bias"]))
        off *= scale / sums
        off[kind, np.arange(len(targets))] -= scale
        slopes["class"] += hidden @ off.T
        slopes["class_bias"] += off.sum(1)
        back = w["class"] @ off
        hidden, targets, scale, within = hidden.take(order, axis=1), targets[order] % CLASS_WORDS, scale[order], np.zeros_like(hidden)
        each, bound = np.arange(len(order)), _bound(w["word"], w["word_bias"])
        for c, some in groups:
            span = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS)
            words, states = w["word"][span], hidden[:, some]
            off = words @ states
            off += w["word_bias"][span][:, None]
            off, sums = _exponents(off, bound)
            off *= scale[some] / sums
            off[targets[some], each[: some.stop - some.start]] -= scale[some]
            np.matmul(off, states.T, out=slopes["word"][span])
            off.sum(1, out=slopes["word_bias"][span])
            np.matmul(words.T, off, out=within[:, some])
        place = np.empty_like(order)
        place[order] = each
        back += within.take(place, axis=1)
        return back

    def train(self, docs: list[np.ndarray], epoch: int, memory: Memory) -> None:
        """One pass of truncated backpropagation: windows of WINDOW steps, the state carried from one to the next."""
        if not docs:
            return
        streams: list[list[np.ndarray]] = [[] for _ in range(min(STREAMS, len(docs)))]
        load = np.zeros(len(streams), np.int64)
        for doc in sorted(docs, key=len, reverse=True):
            at = int(load.argmin())
            streams[at].append(doc)
            load[at] += len(doc)
        longest = np.argsort(-load, kind="stable")  # first, so that a window has the first streams only
        load = load[longest]
        flows = [_flow(streams[i]) for i in longest]
        h = np.zeros((HIDDEN, len(streams)), np.float32)
        for at in range(0, int(load[0]), WINDOW):
            memory.rounds += 1
            active = int(np.searchsorted(-load, -at, "left"))
            if at % (AHEAD * WINDOW) == 0:
                laid = self._laid_out(flows[:active], at)
            step = at % (AHEAD * WINDOW)
            h, slopes = self._window(h[:, :active], *(a[step : step + WINDOW, :active] for a in laid), memory)
            norm = np.sqrt(sum(float(np.vdot(s, s)) for s in slopes.values()))
            clip = min(1.0, CLIP / (norm + 1e-9))
            for k, slope in slopes.items():
                first, second, change = memory.first[k], memory.second[k], memory.change[k]
                first *= np.float32(0.9)
                np.multiply(slope, np.float32(0.1 * clip), out=change)
                first += change
                second *= np.float32(0.99)
                np.multiply(change, change, out=change)  # 0.01 times the square
                second += change
                np.sqrt(second, out=change)
                change *= np.float32(1 / np.sqrt(1 - 0.99**memory.rounds))
                change += np.float32(1e-8)
                np.divide(first, change, out=change)
                change *= np.float32(RATE / (1 + epoch) / (1 - 0.9**memory.rounds))
                self.weights[k] -= change
        self.weights["word_bias"][self.words :] = -1e4

    def _laid_out(self, flows: list[tuple[np.ndarray, np.ndarray]], at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, targets and which are real of streams, by step, for AHEAD windows: room for few steps, however long a stream is."""
        ends = [min(at + AHEAD * WINDOW, len(symbols)) for symbols, _ in flows]
        shape = -(-(max(ends) - at) // WINDOW) * WINDOW, len(flows)
        inputs, targets = np.full(shape, self.words + 1, np.int32), np.full(shape, self.words, np.int32)
        real, skip = np.zeros(shape, bool), int(at == 0)
        for s, ((symbols, begins), end) in enumerate(zip(flows, ends, strict=True)):
            targets[: end - at, s] = symbols[at:end]
            inputs[skip : end - at, s] = symbols[at - 1 + skip : end - 1]
            inputs[begins[slice(*np.searchsorted(begins, (at, end)))] - at, s] = self.words + 1
            real[: end - at, s] = True
        return inputs, targets, real

    def uses(self, tokens: np.ndarray) -> dict[str, np.ndarray]:
        """How many of the tokens, counted by symbol, each row of the weights learned from."""
        kinds = np.append(np.add.reduceat(tokens[: self.words], np.arange(0, self.words, CLASS_WORDS)), tokens[self.words])
        rows = {k: np.full(len(v), float(tokens.sum())) for k, v in self.weights.items()}
        rows["inputs"] = np.append(tokens, tokens.sum()).astype(float)
        rows["word"] = rows["word_bias"] = np.repeat(kinds, CLASS_WORDS).astype(float)
        rows["class_bias"] = np.full(self.classes, float(tokens.sum()))
        return rows

    def _window(self, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, real: np.ndarray, memory: Memory) -> tuple[np.ndarray, dict]:
        """The state after a window and the slopes of all weights."""
        w, slopes = self.weights, memory.slopes
        for slope in slopes.values():
            slope.fill(0)
        steps, wide = inputs.shape
        flat, turned = inputs.ravel(), self._turned()
        goes_on = (inputs != self.words + 1).astype(np.float32)
        begins = (goes_on == 0).any(1).tolist()
        room = lambda name, n: memory.room(name, steps, n, wide)
        x, shares, coefficients, through = (room(k, 3 * HIDDEN) for k in ("x", "shares", "coefficients", "through"))
        before, hidden, n, later, by_n = (room(k, HIDDEN) for k in ("before", "hidden", "n", "later", "by_n"))
        by_feature = lambda name, a: memory.room(name, a.shape[1], steps, wide)
        x[:] = w["inputs"].take(flat, axis=0).reshape(steps, wide, -1).transpose(0, 2, 1)
        for t in range(steps):
            np.multiply(h, goes_on[t] if begins[t] else 1, out=before[t])
            self._step(x[t], before[t], turned, shares[t], n[t], hidden[t])
            h = hidden[t]
        h = h.copy()
        states = by_feature("states", hidden)
        states[:] = hidden.transpose(1, 0, 2)
        back = self._output_slopes(states.reshape(HIDDEN, -1), targets.ravel(), real.ravel(), slopes)
        back = np.ascontiguousarray(back.reshape(states.shape).transpose(1, 0, 2))
        # a state's slope times these are those of the new value and, as the state before has them, of gates and new value
        z, r, inner = shares[:, :HIDDEN], shares[:, HIDDEN : 2 * HIDDEN], shares[:, 2 * HIDDEN :]
        of_z, of_r, of_n = (coefficients[:, i * HIDDEN : (i + 1) * HIDDEN] for i in range(3))
        np.multiply(n, n, out=by_n)
        np.subtract(1, by_n, out=by_n)
        np.subtract(1, z, out=of_z)
        by_n *= of_z
        of_z *= z
        np.subtract(before, n, out=n)
        of_z *= n
        np.multiply(by_n, r, out=of_n)
        np.subtract(1, r, out=of_r)
        of_r *= of_n
        of_r *= inner
        shape, after = (3, HIDDEN, wide), np.zeros((HIDDEN, wide), np.float32)
        for t in range(steps - 1, -1, -1):
            np.add(after, back[t], out=later[t])
            np.multiply(coefficients[t].reshape(shape), later[t], out=through[t].reshape(shape))
            np.matmul(w["state"], through[t], out=after)
            after += np.multiply(later[t], z[t], out=x[t, :HIDDEN])
            if begins[t]:
                after *= goes_on[t]
        states[:] = before.transpose(1, 0, 2)
        slope = by_feature("slope", through)
        slope[:] = through.transpose(1, 0, 2)
        slopes["state"] += states.reshape(HIDDEN, -1) @ slope.reshape(3 * HIDDEN, -1).T
        np.multiply(later, by_n, out=through[:, 2 * HIDDEN :])  # at the input the reset gate has no part in it
        order = np.argsort(flat.astype(np.uint16) if self.words < 1 << 15 else flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        into = memory.room("into", steps * wide, 3 * HIDDEN)
        into.reshape(steps, wide, -1)[:] = through.transpose(0, 2, 1)
        slopes["inputs"][flat[order[first]]] = np.add.reduceat(into.take(order, axis=0), first)
        return h, slopes

    def score(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Natural log probability of each document of symbols, other tokens by class only.

        Documents of like length advance together, longest first; outputs are worked out
        window by window and the state goes on, so a document of any length is
        scored whole.
        """
        order = np.argsort(-np.diff(offsets), kind="stable")
        out = np.zeros(len(order))
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            out[some] = self._together(ids, offsets[:-1][some], np.diff(offsets)[some])
        return out

    def _together(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        totals, turned = np.zeros(len(sizes)), self._turned()
        h = np.zeros((HIDDEN, len(sizes)), np.float32)
        x = np.full(len(sizes), self.words + 1)
        hidden, targets, owners, waiting = [], [], [], 0
        for t in range(int(sizes[0])):
            active = int(np.searchsorted(-sizes, -t, "left"))
            old, h = h[:, :active], np.empty((HIDDEN, active), np.float32)
            shares, n = np.empty((3 * HIDDEN, active), np.float32), np.empty((HIDDEN, active), np.float32)
            self._step(self.weights["inputs"].take(x[:active], axis=0).T, old, turned, shares, n, h)
            x = ids[starts[:active] + t]
            hidden.append(h)
            targets.append(x)
            owners.append(np.arange(active))
            waiting += active
            if waiting > 1 << 14 or t + 1 == sizes[0]:
                logs = self.log_probabilities(np.concatenate(hidden, 1), np.concatenate(targets))
                totals += np.bincount(np.concatenate(owners), logs, len(totals))
                hidden, targets, owners, waiting = [], [], [], 0
        return totals
