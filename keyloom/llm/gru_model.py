"""A gated recurrent language model with a class-factored softmax, in numpy.

Tokens are numbers: the most frequent words have their own and are cut into classes of
equal size; every other word is one of a few tail classes and has no number of its own. A token costs
one softmax over the classes and, for words with a number, one over the words of its class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

HIDDEN = 12
CLASS_SIZE = 32  # words of a class
# Documents that are read side by side, and tokens of a window; gradients stop at its start, the state does not.
LANES, STEPS = 256, 16
SCORED_LANES, SCORED_STEPS = 256, 32
_FILLED = 8  # windows that lanes are filled for at a time
SEGMENT = 4096  # training reads a longer document as several, so that lanes end about together
_LN10 = np.float32(np.log(10))


@dataclass
class Gru:
    """Arrays by name: ``x`` gate inputs by token, ``u`` and ``b`` the gates, ``wc``, ``bc`` classes, ``wo``, ``bo`` words."""

    words: int
    tails: int
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, word_mass: np.ndarray, tail_mass: np.ndarray, hidden: int = HIDDEN, seed: int = 7) -> Gru:
        """A model that gives every token its share of the mass, whatever came before."""
        rng = np.random.default_rng(seed)
        model = cls(len(word_mass), len(tail_mass))
        edges = np.arange(0, model.words, CLASS_SIZE)
        mass = np.concatenate([np.add.reduceat(word_mass, edges), tail_mass])
        within = np.log(word_mass) - np.log(np.repeat(mass[: len(edges)], CLASS_SIZE)[: model.words])
        arrays = {
            "x": rng.normal(0, 0.3, (model.words + model.tails, 3 * hidden)),
            "u": rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)),
            "b": np.zeros(3 * hidden),
            "wc": np.zeros((hidden, len(mass))),
            "bc": np.log(mass / mass.sum()),
            "wo": np.zeros((model.words, hidden)),
            "bo": within,
        }
        model.p = {k: v.astype(np.float32) for k, v in arrays.items()}
        return model

    @property
    def classes(self) -> int:
        return -(-self.words // CLASS_SIZE)

    def to_bytes(self) -> bytes:
        return b"".join(self.p[k].tobytes() for k in sorted(self.p))

    def like(self, blob: bytes) -> Gru:
        """A model of the same shape with the numbers in ``blob``."""
        at, found = 0, {}
        for k in sorted(self.p):
            found[k] = np.frombuffer(blob, np.float32, self.p[k].size, at).reshape(self.p[k].shape).copy()
            at += found[k].nbytes
        return Gru(self.words, self.tails, found)

    def read(self, given: np.ndarray, reset: np.ndarray, h: np.ndarray, back: bool = False) -> tuple[np.ndarray, dict]:
        """States after each token of ``given`` (steps x lanes), and what the way back needs if ``back``."""
        p, k = self.p, h.shape[1]
        steps, lanes = given.shape
        by_token = p["x"] + p["b"]
        by_token[:, 2 * k :] -= p["b"][2 * k :]
        xs = by_token.take(given, axis=0)
        states = np.empty((steps, lanes, k), dtype=np.float32)
        kept = {name: np.empty((steps, lanes, k), dtype=np.float32) for name in ("before", "z", "r", "n", "a") if back}
        fresh = reset.any(axis=1)
        for t in range(steps):
            if fresh[t]:
                h = np.where(reset[t][:, None], np.float32(0), h)
            g = h @ p["u"]
            zr = xs[t, :, : 2 * k] + g[:, : 2 * k]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            a = g[:, 2 * k :] + p["b"][2 * k :]
            z, r = zr[:, :k], zr[:, k:]
            n = np.tanh(xs[t, :, 2 * k :] + r * a)
            if back:
                kept["before"][t], kept["z"][t], kept["r"][t], kept["n"][t], kept["a"][t] = h, z, r, n, a
            h = n + z * (h - n)
            states[t] = h
        return states, kept

    def _classes_of(self, tokens: np.ndarray) -> np.ndarray:
        return np.where(tokens < self.words, tokens // CLASS_SIZE, tokens - self.words + self.classes)

    def log_probability(self, states: np.ndarray, tokens: np.ndarray, slopes: dict | None = None, weight: np.ndarray | None = None) -> np.ndarray:
        """Natural logarithms for ``tokens`` after ``states`` (one row each); with ``slopes``, the gradients of the negative sum go there."""
        p = self.p
        # States are within 1, so this bounds all logits; exp holds out to 88.
        small = max(np.abs(p["wc"]).sum(axis=0).max() + np.abs(p["bc"]).max(), np.abs(p["wo"]).sum(axis=1).max() + np.abs(p["bo"]).max()) < 60
        cls = self._classes_of(tokens)
        rows = np.arange(len(tokens))
        logits = states @ p["wc"]
        logits += p["bc"]
        if not small:
            logits -= logits.max(axis=1, keepdims=True)
        own = logits[rows, cls]
        np.exp(logits, out=logits)
        total = logits.sum(axis=1)
        found = own - np.log(total)
        if slopes is not None:
            logits /= total[:, None]
            logits[rows, cls] -= 1
            if weight is not None:
                logits *= weight[:, None]
            slopes["wc"], slopes["bc"] = states.T @ logits, logits.sum(axis=0)
            slopes["states"] = logits @ p["wc"].T
            slopes["wo"], slopes["bo"] = np.zeros_like(p["wo"]), np.zeros_like(p["bo"])
        order = np.argsort(cls.astype(np.int16), kind="stable")  # by radix
        edges = np.cumsum(np.bincount(cls, minlength=self.classes)[: self.classes]).tolist()
        edges.insert(0, 0)
        whole = self.words // CLASS_SIZE
        # Classes of one size go through the softmax together, their rows side by side.
        for own_classes, size in ((range(whole), CLASS_SIZE), (range(whole, self.classes), self.words % CLASS_SIZE)):
            first, last = edges[own_classes.start], edges[own_classes.stop]
            if first == last:
                continue
            at = order[first:last]
            h = states[at]
            logits = np.empty((last - first, size), dtype=np.float32)
            parts = [(slice(edges[c] - first, edges[c + 1] - first), slice(c * CLASS_SIZE, c * CLASS_SIZE + size)) for c in own_classes if edges[c + 1] > edges[c]]
            for part, block in parts:
                np.matmul(h[part], p["wo"][block].T, out=logits[part])
                logits[part] += p["bo"][block]
            if not small:
                logits -= logits.max(axis=1, keepdims=True)
            mine = tokens[at] % CLASS_SIZE
            rows = np.arange(last - first)
            own = logits[rows, mine]
            np.exp(logits, out=logits)
            total = logits.sum(axis=1)
            found[at] += own - np.log(total)
            if slopes is not None:
                logits /= total[:, None]
                logits[rows, mine] -= 1
                if weight is not None:
                    logits *= weight[at][:, None]
                back = np.empty_like(h)
                for part, block in parts:
                    slopes["wo"][block], slopes["bo"][block] = logits[part].T @ h[part], logits[part].sum(axis=0)
                    np.matmul(logits[part], p["wo"][block], out=back[part])
                slopes["states"][at] += back
        return found

    def slopes(self, given: np.ndarray, wanted: np.ndarray, reset: np.ndarray, live: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray, float]:
        """Gradients over one window, truncated at its start; the state after it; the sum of logarithms."""
        p, k = self.p, h.shape[1]
        steps, lanes = given.shape
        states, kept = self.read(given, reset, h, back=True)
        out: dict[str, np.ndarray] = {}
        weight = None if live.all() else live.ravel().astype(np.float32)
        found = self.log_probability(states.reshape(-1, k), wanted.ravel(), out, weight)
        from_out = out.pop("states").reshape(steps, lanes, k)
        d_g = np.empty((steps, lanes, 3 * k), dtype=np.float32)
        d_n = np.empty((steps, lanes, k), dtype=np.float32)
        dh = np.zeros((lanes, k), dtype=np.float32)
        ut = p["u"].T.copy()
        for t in range(steps - 1, -1, -1):
            dh += from_out[t]
            z, r, n, a, before = kept["z"][t], kept["r"][t], kept["n"][t], kept["a"][t], kept["before"][t]
            g = d_g[t]
            keep = dh * z
            dn = (dh - keep) * (1 - n * n)
            d_n[t] = dn
            g[:, :k] = dh * (before - n) * z * (1 - z)
            g[:, k : 2 * k] = dn * a * r * (1 - r)
            g[:, 2 * k :] = dn * r
            dh = keep + g @ ut
            if reset[t].any():
                dh *= ~reset[t][:, None]
        flat = d_g.reshape(-1, 3 * k)
        out["u"] = kept["before"].reshape(-1, k).T @ flat
        out["b"] = flat.sum(axis=0)
        flat = flat.copy()
        flat[:, 2 * k :] = d_n.reshape(-1, k)
        at = given.ravel()
        order = np.argsort(at.astype(np.int16), kind="stable")
        at = at[order]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        out["x"] = (at[starts], np.add.reduceat(flat[order], starts, axis=0))
        return out, states[-1], float((found if weight is None else found * weight).sum())


class Adagrad:
    """Steps that shrink with the squares of the gradients seen so far, per number."""

    def __init__(self, model: Gru, rate: float):
        self.model, self.rate = model, rate
        self.seen = {k: np.full_like(v, 1e-2) for k, v in model.p.items()}

    def step(self, slopes: dict) -> None:
        for k, g in slopes.items():
            p, s = self.model.p[k], self.seen[k]
            if isinstance(g, tuple):
                at, g = g
                s[at] += g * g
                p[at] -= self.rate * g / np.sqrt(s[at])
            else:
                s += g * g
                p -= self.rate * g / np.sqrt(s)


def windows(documents: Iterator[np.ndarray], start: int, lanes: int = LANES, steps: int = STEPS):
    """Documents read side by side: ``given, wanted, reset, live, number, kept`` per window (steps x lanes).

    A lane goes on with the next document in the step after its last one ended. ``number`` counts the
    documents as they came; ``kept`` picks the lanes of the last window that go on, once none are left to begin.
    Lanes are filled for several windows at a time.
    """
    coming = enumerate(documents)
    held = [[doc, ids, 0] for _, (doc, ids) in zip(range(lanes), coming)]
    wide = steps * _FILLED
    kept: list[int] | slice = list(range(len(held)))
    while held:
        n = len(held)
        given, wanted = np.full((n, wide), start, dtype=np.int32), np.full((n, wide), start, dtype=np.int32)
        reset, live = np.zeros((n, wide), dtype=bool), np.zeros((n, wide), dtype=bool)
        owner = np.zeros((n, wide), dtype=np.int64)
        for j, lane in enumerate(held):
            t = 0
            while t < wide and lane is not None:
                doc, ids, at = lane
                size = min(wide - t, len(ids) - at)
                wanted[j, t : t + size] = ids[at : at + size]
                if at:
                    given[j, t : t + size] = ids[at - 1 : at + size - 1]
                else:
                    reset[j, t] = True
                    given[j, t + 1 : t + size] = ids[: size - 1]
                live[j, t : t + size] = True
                owner[j, t : t + size] = doc
                t += size
                lane[2] = at + size
                if lane[2] == len(ids):
                    doc, ids = next(coming, (0, None))
                    lane = None if ids is None else [doc, ids, 0]
            held[j] = lane
        for t in range(0, wide, steps):
            part = slice(t, t + steps)
            if live[:, t].any():
                yield given[:, part].T, wanted[:, part].T, reset[:, part].T, live[:, part].T, owner[:, part].T, kept
                kept = slice(None)
        kept = [j for j, lane in enumerate(held) if lane is not None]
        held = [held[j] for j in kept]


def train(model: Gru, documents: Iterator[np.ndarray], start: int, rate: float) -> tuple[int, float]:
    """One pass over ``documents``, changing ``model``; tokens read and the sum of their logarithms."""
    optimizer = Adagrad(model, rate)
    h = np.zeros((LANES, model.p["u"].shape[0]), dtype=np.float32)  # as many as begin
    tokens, total = 0, 0.0
    segments = (ids[at : at + SEGMENT] for ids in documents for at in range(0, len(ids), SEGMENT))
    for given, wanted, reset, live, _, kept in windows(segments, start):
        slopes, h, found = model.slopes(given, wanted, reset, live, h[kept])
        scale = np.float32(1 / LANES)  # the same for the last windows, in which few lanes are left
        optimizer.step({k: (g[0], g[1] * scale) if isinstance(g, tuple) else g * scale for k, g in slopes.items()})
        tokens += int(live.sum())
        total += found
    return tokens, total


def score(model: Gru, documents: Iterator[np.ndarray], start: int) -> Iterator[tuple[int, float]]:
    """Number and log10 probability of each document, as they end, which is with ``start``. The state runs through whole documents."""
    h = np.zeros((SCORED_LANES, model.p["u"].shape[0]), dtype=np.float32)
    sums: dict[int, float] = {}
    for given, wanted, reset, live, owner, kept in windows(documents, start, SCORED_LANES, SCORED_STEPS):
        states, _ = model.read(given, reset, h[kept])
        h = states[-1]
        found = model.log_probability(states.reshape(-1, h.shape[1]), wanted.ravel()).astype(np.float64)
        at = live.ravel()
        docs, place = np.unique(owner.ravel()[at], return_inverse=True)
        added = np.bincount(place, weights=found[at])
        for doc, value in zip(docs.tolist(), added.tolist(), strict=True):
            sums[doc] = sums.get(doc, 0.0) + value
        for doc in owner[live & (wanted == start)].tolist():  # the end of a document
            yield doc, sums.pop(doc) / float(_LN10)
