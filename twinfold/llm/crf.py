"""Linear-chain conditional random fields in NumPy.

A token is known by its kind (a number); a kind has features of its own, and the kinds
before and after a token may add to its scores through feature tables of their own.
Everything of a text that does not depend on the neighbours is worked out once per kind.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np

CELLS = 400_000  # tokens, padding included, that are decoded together
NEW_KINDS = 8192  # new kinds that are described together


def hashed(features: Iterable[str], size: int) -> list[int]:
    """Feature numbers by hashing; ``size`` is a power of two."""
    return [zlib.crc32(f.encode()) & (size - 1) for f in features]


class Features:
    """Feature numbers of many kinds, as one array and the places where kinds begin."""

    def __init__(self, per_kind: list[list[int]]):
        self.counts = np.fromiter(map(len, per_kind), np.int64, len(per_kind))
        self.ids = np.fromiter((i for f in per_kind for i in f), np.int64, int(self.counts.sum()))
        self.starts = np.cumsum(self.counts) - self.counts

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Sum of the rows of ``weights`` per kind.  Every kind has a feature."""
        if not len(self.ids):
            return np.zeros((len(self.counts), weights.shape[1]))
        return np.add.reduceat(weights[self.ids], self.starts, axis=0)

    def gradient(self, per_kind: np.ndarray, size: int) -> np.ndarray:
        """What kinds' gradients add up to per feature."""
        rows = np.repeat(per_kind, self.counts, axis=0)
        return np.stack(
            [np.bincount(self.ids, rows[:, s], minlength=size) for s in range(rows.shape[1])], axis=1
        )


def padded(lengths: np.ndarray, cells: int = CELLS) -> Iterator[np.ndarray]:
    """Numbers of sequences, longest first, in portions of at most ``cells`` padded tokens
    or a single sequence."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order) and lengths[order[at]] > 0:
        rows = max(1, cells // int(lengths[order[at]]))
        yield order[at : at + rows]
        at += rows


def forward_backward(
    potentials: np.ndarray, transitions: np.ndarray, active: np.ndarray, pairs: bool = False
) -> tuple[np.ndarray, np.ndarray | None, float]:
    """Marginals (time, sequence, state), expected transitions, and the log of the norms.

    ``potentials`` is (time, sequence, state), longest sequence first; ``active`` counts the
    sequences that have a token at each time; ``transitions`` are positive.
    """
    steps = len(potentials)
    alpha = np.zeros_like(potentials)
    beta = np.zeros_like(potentials)
    log_norm = 0.0
    for t in range(steps):
        n = active[t]
        a = potentials[t, :n] if t == 0 else (alpha[t - 1, :n] @ transitions) * potentials[t, :n]
        norm = a.sum(axis=1, keepdims=True)
        alpha[t, :n] = a / norm
        if pairs:
            log_norm += float(np.log(norm).sum())
    expected = np.zeros_like(transitions) if pairs else None
    for t in range(steps - 1, -1, -1):
        n, m = active[t], active[t + 1] if t + 1 < steps else 0
        beta[t, m:n] = 1.0
        if m:
            ahead = potentials[t + 1, :m] * beta[t + 1, :m]
            b = ahead @ transitions.T
            norm = (alpha[t, :m] * b).sum(axis=1, keepdims=True)
            if pairs:
                expected += (alpha[t, :m].T @ (ahead / norm)) * transitions
            beta[t, :m] = b / norm
    marginals = alpha * beta
    return marginals, expected, log_norm


class Chain:
    """Weights of a field with ``states`` states and a feature table per place (own, before,
    after)."""

    def __init__(self, states: int, size: int, places: int = 1):
        self.states, self.size, self.places = states, size, places
        self.weights = [np.zeros((size, states)) for _ in range(places)]
        self.transitions = np.zeros((states, states))

    def fit(
        self,
        features: list[Features],
        tokens: list[np.ndarray],
        labels: list[np.ndarray],
        rounds: int = 40,
        rate: float = 0.25,
        penalty: float = 1e-5,
    ) -> Chain:
        """Maximise the conditional log-likelihood by Adam over the whole sample.

        ``features[p]`` are those of the kinds at place ``p``; ``tokens`` hold kinds.
        """
        lengths = np.array([len(t) for t in tokens])
        total = int(lengths.sum())
        if not total:
            return self
        chunks = []
        for rows in padded(lengths, max(1, CELLS * 8 // max(8, self.states))):
            steps = int(lengths[rows[0]])
            kinds = np.zeros((steps, len(rows)), np.int64)
            want = np.full((steps, len(rows)), -1)
            for j, r in enumerate(rows):
                kinds[: lengths[r], j], want[: lengths[r], j] = tokens[r], labels[r]
            active = (want >= 0).sum(axis=1)
            chunks.append((kinds, want, active))
        params = [*self.weights, self.transitions]
        first = [np.zeros_like(p) for p in params]
        second = [np.zeros_like(p) for p in params]
        for step in range(1, rounds + 1):
            kind_scores = [f.scores(w) for f, w in zip(features, self.weights)]
            per_kind = [np.zeros_like(s) for s in kind_scores]
            gradient_t = np.zeros_like(self.transitions)
            for kinds, want, active in chunks:
                there = want >= 0
                potentials = np.exp(self._scores(kind_scores, kinds, there))
                marginals, expected, _ = forward_backward(potentials, np.exp(self.transitions), active, True)
                error = -marginals
                t, j = np.nonzero(there)
                error[t, j, want[t, j]] += 1
                error[~there] = 0
                for p, places in enumerate(self._placed(kinds, there)):
                    valid, at = places
                    for s in range(self.states):
                        per_kind[p][:, s] += np.bincount(
                            kinds[valid], error[..., s][at], minlength=len(per_kind[p])
                        )
                follows = there[1:]
                np.add.at(gradient_t, (want[:-1][follows], want[1:][follows]), 1)
                gradient_t -= expected
            gradients = [f.gradient(g, self.size) for f, g in zip(features, per_kind)] + [gradient_t]
            for p, g, m, v in zip(params, gradients, first, second):
                g = g / total - penalty * p
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return self

    def _placed(self, kinds: np.ndarray, there: np.ndarray) -> Iterator[tuple[tuple, tuple]]:
        """For each place: the cells whose kind counts, and the cells it counts for."""
        t, j = np.nonzero(there)
        yield (t, j), (t, j)
        t, j = np.nonzero(there[1:])  # a token with one before it
        if self.places > 1:
            yield (t, j), (t + 1, j)
        if self.places > 2:
            yield (t + 1, j), (t, j)

    def _scores(self, kind_scores: list[np.ndarray], kinds: np.ndarray, there: np.ndarray) -> np.ndarray:
        scores = np.zeros((*kinds.shape, self.states))
        for table, (valid, at) in zip(kind_scores, self._placed(kinds, there)):
            scores[at] += table[kinds[valid]]
        return scores


class KindScores:
    """Scores of the kinds met so far, as ``finish`` makes them; new ones are added in one go, and
    all are forgotten when there are too many."""

    def __init__(
        self,
        chain: Chain,
        describe: Callable[[str], list[list[int]]],
        finish: Callable[[np.ndarray], np.ndarray] = lambda scores: scores,
        most: int = 500_000,
    ):
        self.chain, self.describe, self.finish, self.most = chain, describe, finish, most
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.tables = [np.zeros((1024, self.chain.states)) for _ in range(self.chain.places)]

    def add(self, words: set[str]) -> None:
        """Make sure all ``words`` have numbers."""
        new = words.difference(self.numbers)
        if len(self.numbers) + len(new) > self.most:
            self.clear()
            new = words
        new = list(new)
        for at in range(0, len(new), NEW_KINDS):
            self._add(new[at : at + NEW_KINDS])

    def _add(self, new: list[str]) -> None:
        described = [self.describe(w) for w in new]
        at = len(self.numbers)
        for p in range(self.chain.places):
            found = self.finish(Features([d[p] for d in described]).scores(self.chain.weights[p]))
            if at + len(new) > len(self.tables[p]):
                larger = np.zeros((2 * (at + len(new)), self.chain.states))
                larger[:at] = self.tables[p][:at]
                self.tables[p] = larger
            self.tables[p][at : at + len(new)] = found
        self.numbers.update(zip(new, range(at, at + len(new))))
