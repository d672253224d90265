"""A bidirectional LSTM over characters with CRF transitions, in numpy.

Gates and cells use x / (1 + |x|) in place of tanh and its shifted half in place of the
logistic function: as smooth, and several times faster on arrays.  Arrays are laid out
(units, batch), so that every gate is one contiguous block.
"""

from __future__ import annotations

import numpy as np

F4 = np.float32


def _soft(x: np.ndarray, out: np.ndarray, work: np.ndarray) -> None:
    np.abs(x, out=work)
    work += F4(1)
    np.divide(x, work, out=out)


class Lstm:
    """One direction: gates i, f, o and the candidate g, stacked in this order."""

    def __init__(self, rng: np.random.Generator, classes: int, units: int):
        self.x = (rng.normal(size=(4 * units, classes)) * 0.5).astype(F4)
        self.x[units : 2 * units] += F4(1)
        self.u = (rng.normal(size=(4 * units, units)) / np.sqrt(units)).astype(F4)
        self.units = units

    def run(self, codes: np.ndarray) -> np.ndarray:
        """Hidden states (time, units, batch) over ``codes`` (time, batch)."""
        n, (steps, batch) = self.units, codes.shape
        out = np.empty((steps, n, batch), F4)
        h, c = np.zeros((n, batch), F4), np.zeros((n, batch), F4)
        z, g, work = (np.empty((4 * n, batch), F4) for _ in range(3))
        new, small = np.empty((n, batch), F4), np.empty((n, batch), F4)
        for t in range(steps):
            np.take(self.x, codes[t], axis=1, out=g, mode="clip")
            np.dot(self.u, h, out=z)
            z += g
            _soft(z, z, work)
            gates = z[: 3 * n]
            gates *= F4(0.5)
            gates += F4(0.5)
            np.multiply(z[:n], z[3 * n :], out=new)
            c *= z[n : 2 * n]
            c += new
            _soft(c, new, small)
            h = out[t]
            np.multiply(new, z[2 * n : 3 * n], out=h)
        return out

    def learn(self, codes: np.ndarray):
        """Hidden states, and a function from their gradients to those of x and u."""
        n, (steps, batch) = self.units, codes.shape
        h, c = np.zeros((n, batch), F4), np.zeros((n, batch), F4)
        kept = []
        out = np.empty((steps, n, batch), F4)
        for t in range(steps):
            z = self.u @ h + self.x[:, codes[t]]
            d = 1 / (1 + np.abs(z))
            s = z * d
            i, f, o, g = 0.5 * s[:n] + 0.5, 0.5 * s[n : 2 * n] + 0.5, 0.5 * s[2 * n : 3 * n] + 0.5, s[3 * n :]
            before = h, c
            c = f * c + i * g
            e = 1 / (1 + np.abs(c))
            h = o * c * e
            kept.append((before, i, f, o, g, d * d, c * e, e * e))
            out[t] = h

        def back(grad: np.ndarray):
            gx, gu = np.zeros_like(self.x), np.zeros_like(self.u)
            dh, dc = np.zeros((n, batch), F4), np.zeros((n, batch), F4)
            for t in reversed(range(steps)):
                (h0, c0), i, f, o, g, dz, s, ds = kept[t]
                dh = dh + grad[t]
                dc = dc + dh * o * ds
                gz = np.concatenate([0.5 * dc * g, 0.5 * dc * c0, 0.5 * dh * s, dc * i]) * dz
                np.add.at(gx.T, codes[t], gz.T)
                gu += gz @ h0.T
                dh, dc = self.u.T @ gz, dc * f
            return gx, gu

        return out, back


class Tagger:
    """Scores of tags per character and of tags in succession; tag 0 is outside."""

    def __init__(self, classes: int, tags: int, units: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.ahead, self.astern = Lstm(rng, classes, units), Lstm(rng, classes, units)
        self.v = (rng.normal(size=(tags, 2 * units)) * 0.3).astype(F4)
        self.b = np.zeros((tags, 1), F4)
        self.b[0] = 2
        self.follow = np.zeros((tags, tags), F4)

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """(time, tags, batch)."""
        n = self.ahead.units
        out = np.matmul(self.v[:, :n], self.ahead.run(codes))
        out += np.matmul(self.v[:, n:], self.astern.run(codes[::-1]))[::-1]
        out += self.b
        return out

    def tags(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The batch columns with a tag other than 0, and the best tags (time, column) of these.

        Leaving the outside for a run of tags and coming back gains at most twice the
        largest difference of transitions per character.  Where no character's score
        makes up for less than that, staying outside is best, and nothing is decoded.
        """
        scores = self.scores(codes)
        gain = scores[:, 1:].max(axis=1) - scores[:, 0]
        most = 2 * float(max(0, (self.follow - self.follow[0, 0]).max()))
        live = np.flatnonzero((gain + most > 0).any(axis=0))
        if not len(live):
            return live, np.zeros((len(codes), 0), np.int8)
        found = self.best(scores[:, :, live])
        some = (found > 0).any(axis=0)
        return live[some], found[:, some]

    def best(self, scores: np.ndarray) -> np.ndarray:
        """Viterbi paths."""
        steps, k, batch = scores.shape
        total, origin = scores[0], np.empty((steps, k, batch), np.int8)
        for t in range(1, steps):
            each = total[:, None] + self.follow[:, :, None]
            origin[t] = each.argmax(axis=0)
            total = each.max(axis=0) + scores[t]
        path = np.empty((steps, batch), np.int8)
        path[-1] = total.argmax(axis=0)
        columns = np.arange(batch)
        for t in range(steps - 1, 0, -1):
            path[t - 1] = origin[t, path[t], columns]
        return path

    def loss_and_gradients(self, codes: np.ndarray, tags: np.ndarray):
        n = self.ahead.units
        one, back_one = self.ahead.learn(codes)
        two, back_two = self.astern.learn(codes[::-1])
        both = np.concatenate([one, two[::-1]], axis=1)
        scores = np.matmul(self.v, both) + self.b
        steps, k, batch = scores.shape
        lead = scores.max(axis=1, keepdims=True)
        e, m = np.exp(scores - lead), np.exp(self.follow)
        alpha, norm = np.empty_like(e), np.empty((steps, 1, batch), F4)
        now = e[0]
        for t in range(steps):
            if t:
                now = (m.T @ alpha[t - 1]) * e[t]
            norm[t] = now.sum(axis=0)
            alpha[t] = now / norm[t]
        beta = np.ones((k, batch), F4)
        wanted = np.eye(k, dtype=F4)[tags].transpose(0, 2, 1)
        d_scores, d_follow = np.empty_like(scores), np.zeros_like(self.follow)
        for t in reversed(range(steps)):
            d_scores[t] = alpha[t] * beta - wanted[t]
            if t:
                right = beta * e[t] / norm[t]
                d_follow += m * (alpha[t - 1] @ right.T) - wanted[t - 1] @ wanted[t].T
                beta = m @ right
        gold = (scores * wanted).sum() + sum(self.follow[tags[t - 1], tags[t]].sum() for t in range(1, steps))
        loss = (np.log(norm).sum() + lead.sum() - gold) / batch
        d_scores /= batch
        d_follow /= batch
        d_both = np.matmul(self.v.T, d_scores)
        gradients = [*back_one(d_both[:, :n]), *back_two(d_both[::-1, n:])]
        return loss, [*gradients, np.einsum("tkb,tnb->kn", d_scores, both), d_scores.sum(axis=(0, 2))[:, None], d_follow]

    @property
    def weights(self) -> list[np.ndarray]:
        return [self.ahead.x, self.ahead.u, self.astern.x, self.astern.u, self.v, self.b, self.follow]

    def fit(self, codes: np.ndarray, tags: np.ndarray, *, rounds: int, batch: int = 192, rate: float = 0.03, seed: int = 3) -> float:
        """Adam over random batches of ``codes`` and ``tags`` (time, example); the last loss."""
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        loss = 0.0
        for step in range(1, rounds + 1):
            pick = rng.integers(0, codes.shape[1], batch)
            loss, gradients = self.loss_and_gradients(codes[:, pick], tags[:, pick])
            length = np.sqrt(sum(float((g * g).sum()) for g in gradients))
            pace = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
            for w, g, a, b in zip(self.weights, gradients, first, second, strict=True):
                g = g * F4(min(1.0, 5 / (length + 1e-9)))
                a += F4(0.1) * (g - a)
                b += F4(0.01) * (g * g - b)
                w -= F4(pace) * (a / F4(1 - 0.9**step)) / (np.sqrt(b / F4(1 - 0.99**step)) + F4(1e-6))
        return float(loss)
