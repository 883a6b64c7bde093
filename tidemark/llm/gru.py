"""A small gated recurrent network with a class-factored softmax, in numpy."""

from __future__ import annotations

import numpy as np


def _sigmoid(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    x = np.maximum(x, -30, out=out)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _normalised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """In place, column by column: exponentials that are not yet divided by their sums; the greatest values and the sums."""
    most = x.max(axis=0)
    x -= most
    np.exp(x, out=x)
    return x, most, x.sum(axis=0)


class Gru:
    """Next-token model over ``size`` ids; id ``i`` is word ``i % width`` of class ``i // width``.

    Ids are ranks by frequency, so classes hold words of like frequency. The output biases start from
    the ids' counts, which makes the untrained model the unigram one.
    """

    def __init__(self, counts: np.ndarray, hidden: int = 24, width: int = 32, seed: int = 5):
        self.size, self.hidden, self.width = len(counts), hidden, width
        self.classes = -(-self.size // width)
        rng = np.random.default_rng(seed)
        weights = np.zeros(self.classes * width)
        weights[: self.size] = np.asarray(counts, float) + 0.5
        table = weights.reshape(self.classes, width)
        of_class = table.sum(axis=1)
        with np.errstate(divide="ignore"):
            inside = np.log(table / of_class[:, None])

        def draw(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {
            "x": draw(self.size, 3 * hidden, scale=0.1),
            "u": draw(hidden, 3 * hidden, scale=hidden**-0.5),
            "b": np.zeros(3 * hidden, np.float32),
            "c": draw(hidden, self.classes, scale=0.02),
            "cb": np.log(of_class / of_class.sum()).astype(np.float32),
            "w": draw(self.classes, hidden, width, scale=0.02),
            # Places beyond the last id can't be drawn.
            "wb": np.maximum(inside, -1e9).astype(np.float32),
        }

    def step(self, tokens: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The next state, and what the way back needs."""
        n = self.hidden
        gates = self.p["x"][tokens] + self.p["b"]
        rec = h @ self.p["u"]
        zr = _sigmoid(gates[:, : 2 * n] + rec[:, : 2 * n])
        z, r = zr[:, :n], zr[:, n:]
        new = np.tanh(gates[:, 2 * n :] + r * rec[:, 2 * n :])
        return new + z * (h - new), (tokens, h, z, r, new, rec[:, 2 * n :])

    def _by_class(self, cls: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """The order of places by class, and ``class, begin, end`` of each that occurs."""
        order = np.argsort(cls.astype(np.int16), kind="stable")
        cuts = np.searchsorted(cls[order], np.arange(self.classes + 1)).tolist()
        return order, [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if a < b]

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of each target after its state."""
        cls, word = targets // self.width, targets % self.width
        # Places lie side by side, so that sums over a class run along them.
        x = self.p["c"].T @ states.T + self.p["cb"][:, None]
        out = x[cls, np.arange(len(targets))].astype(np.float64)
        _, most, total = _normalised(x)
        out -= most + np.log(total)
        order, parts = self._by_class(cls)
        sorted_states, sorted_word, inside = states[order], word[order], np.empty(len(targets))
        for k, a, b in parts:
            x = self.p["w"][k].T @ sorted_states[a:b].T + self.p["wb"][k][:, None]
            picked = x[sorted_word[a:b], np.arange(b - a)]
            _, most, total = _normalised(x)
            inside[a:b] = picked - most - np.log(total)
        out[order] += inside
        return out

    def _output_slopes(self, states: np.ndarray, targets: np.ndarray, g: dict[str, np.ndarray]) -> tuple[np.ndarray, float]:
        """Adds the slopes of the mean loss by the output weights; returns those by the states, and the mean loss."""
        n, cls, word = len(targets), targets // self.width, targets % self.width
        places = np.arange(n)
        d, _, total = _normalised(self.p["c"].T @ states.T + self.p["cb"][:, None])
        d /= total
        loss = np.log(d[cls, places]).sum(dtype=float)
        d[cls, places] -= 1
        d /= n
        g["c"] += (d @ states).T
        g["cb"] += d.sum(axis=1)
        back = d.T @ self.p["c"].T
        order, parts = self._by_class(cls)
        sorted_states, sorted_word, more = states[order], word[order], np.empty_like(back)
        for k, a, b in parts:
            own = sorted_states[a:b]
            e, _, total = _normalised(self.p["w"][k].T @ own.T + self.p["wb"][k][:, None])
            e /= total
            loss += np.log(e[sorted_word[a:b], places[: b - a]]).sum(dtype=float)
            e[sorted_word[a:b], places[: b - a]] -= 1
            e /= n
            g["w"][k] += (e @ own).T
            g["wb"][k] += e.sum(axis=1)
            np.matmul(e.T, self.p["w"][k].T, out=more[a:b])
        back[order] += more
        return back, -loss / n

    def slopes(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Backpropagation through one window of ``streams x steps``; the state that goes on, the mean loss."""
        g, n, p = {k: np.zeros_like(v) for k, v in self.p.items()}, self.hidden, self.p
        steps, streams = inputs.shape[1], len(h)
        seen, wanted = inputs.T.reshape(-1), targets.T.reshape(-1)
        # The three gates lie apart, each in one piece; they turn into ``z, r, new`` in place.
        u = np.ascontiguousarray(p["u"].reshape(n, 3, n).transpose(1, 0, 2))
        table = (p["x"] + p["b"]).reshape(-1, 3, n).transpose(1, 0, 2)
        gates = np.empty((steps, 3, streams, n), table.dtype)
        for k in range(3):
            gates[:, k] = table[k].take(seen, axis=0).reshape(steps, streams, n)
        states, rec = np.empty((steps + 1, streams, n), gates.dtype), np.empty((steps, streams, n), gates.dtype)
        states[0] = h
        for t in range(steps):
            h, zr, new = states[t], gates[t, :2], gates[t, 2]
            zr += h @ u[:2]
            _sigmoid(zr, out=zr)
            np.matmul(h, u[2], out=rec[t])
            new += zr[1] * rec[t]
            np.tanh(new, out=new)
            np.subtract(h, new, out=states[t + 1])
            states[t + 1] *= zr[0]
            states[t + 1] += new
        outer, loss = self._output_slopes(states[1:].reshape(-1, n), wanted, g)
        outer = outer.reshape(steps, streams, n)
        z, r, new = gates[:, 0], gates[:, 1], gates[:, 2]
        by_new, by_z, by_r = (1 - z) * (1 - new * new), (states[:-1] - new) * z * (1 - z), rec * r * (1 - r)
        d, drec = np.empty_like(gates), rec
        back = np.ascontiguousarray(u.transpose(0, 2, 1))
        dh = np.zeros_like(states[0])
        for t in reversed(range(steps)):
            dh += outer[t]
            np.multiply(dh, by_z[t], out=d[t, 0])
            np.multiply(dh, by_new[t], out=d[t, 2])
            np.multiply(d[t, 2], by_r[t], out=d[t, 1])
            np.multiply(d[t, 2], r[t], out=drec[t])
            dh *= z[t]
            dh += d[t, 0] @ back[0]
            dh += d[t, 1] @ back[1]
            dh += drec[t] @ back[2]
        # The weights' slopes of the whole window at once; those of a token are added up where it lies together.
        rows = d.transpose(0, 2, 1, 3).reshape(-1, 3 * n)
        order = np.argsort(seen.astype(np.int16) if self.size <= 1 << 15 else seen, kind="stable")
        ids, begins = np.unique(seen[order], return_index=True)
        by_id = np.add.reduceat(rows[order], begins, axis=0)
        g["x"][ids] += by_id
        g["b"] += by_id.sum(axis=0)
        before = states[:-1].reshape(-1, n).T
        g["u"] += np.concatenate([before @ rows[:, : 2 * n], before @ drec.reshape(-1, n)], axis=1)
        return g, states[-1], loss

    def fit(self, stream: np.ndarray, *, streams: int = 64, window: int = 32, epochs: int = 3, rate: float = 0.004) -> Gru:
        """Truncated backpropagation: windows follow each other, and the state goes on from one to the next."""
        length = (len(stream) - 1) // streams
        if length < 1:
            return self
        x, y = stream[: streams * length].reshape(streams, length), stream[1 : streams * length + 1].reshape(streams, length)
        m, s, n = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for _ in range(epochs):
            h = np.zeros((streams, self.hidden), np.float32)
            for at in range(0, length, window):
                g, h, _ = self.slopes(x[:, at : at + window], y[:, at : at + window], h)
                norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                n += 1
                for k, v in g.items():
                    v = v / max(norm, 1.0)
                    m[k] += 0.1 * (v - m[k])
                    s[k] += 0.001 * (v * v - s[k])
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**n)) / (np.sqrt(s[k] / (1 - 0.999**n)) + 1e-8)).astype(np.float32)
        return self

    def sequences(self, tokens: np.ndarray, lengths: np.ndarray, start: int, chunk: int = 8_192) -> np.ndarray:
        """Natural logarithms of the probabilities of all tokens of whole sequences that lie end to end.

        All sequences go on in step; each one's state is carried from its first token to its last.
        """
        out, n = np.zeros(len(tokens)), self.hidden
        begins = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        begins, left = begins[order], lengths[order]
        alive = int((left > 0).sum())
        # How many sequences are left after each step; most steps have few, so a step is as few calls as there can be.
        ends = np.bincount(left[:alive], minlength=1)
        after = (alive - np.cumsum(ends))[1:].tolist()
        gates_of, u = self.p["x"] + self.p["b"], self.p["u"]
        # The gates lie apart, each in one piece.
        zr_of, new_of, zr_u, new_u = (np.ascontiguousarray(v) for v in (gates_of[:, : 2 * n], gates_of[:, 2 * n :], u[:, : 2 * n], u[:, 2 * n :]))
        h = np.zeros((alive, n), np.float32)
        before = np.full(alive, start, np.int64)
        states, places, held = [], [], 0
        at = begins[:alive].copy()
        for now in after:
            zr, more = h @ zr_u, h @ new_u
            zr += zr_of.take(before, axis=0)
            _sigmoid(zr, out=zr)
            more *= zr[:, n:]
            new = new_of.take(before, axis=0)
            new += more
            np.tanh(new, out=new)
            h = h - new
            h *= zr[:, :n]
            h += new
            states.append(h)
            places.append(at)
            held += len(at)
            if held >= chunk or not now:
                flat = np.concatenate(places)
                out[flat] = self.log_probabilities(np.concatenate(states), tokens[flat])
                states, places, held = [], [], 0
            before = tokens.take(at[:now])
            h, at = h[:now], at[:now] + 1
        return out
