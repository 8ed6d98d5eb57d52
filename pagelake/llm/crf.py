"""A linear-chain conditional random field with two labels, in numpy."""

from __future__ import annotations

import numpy as np


class LinearChain:
    """Weights of binary features by label, of label pairs and first labels.

    ``fit`` maximises the L2-regularised log-likelihood of labelled sequences
    with Adam steps on exact gradients (forward-backward over all sequences at
    once); it starts from zero, so equal data give equal weights.
    """

    LABELS = 2

    def __init__(self):
        self.names: dict[str, int] = {}
        self.emit = np.zeros((1, 2))
        self.step = np.zeros((2, 2))
        self.first = np.zeros(2)

    def rows(self, features: list[str]) -> list[int]:
        return [self.names[f] for f in features if f in self.names]

    def fit(self, sequences: list[list[list[str]]], labels: list[list[int]], rounds: int = 150,
            rate: float = 0.1, penalty: float = 0.1, seen: int = 2) -> "LinearChain":
        kept = [(s, y) for s, y in zip(sequences, labels) if s]
        counts: dict[str, int] = {}
        for s, _ in kept:
            for block in s:
                for f in set(block):
                    counts[f] = counts.get(f, 0) + 1
        self.names = {f: i + 1 for i, f in enumerate(sorted(f for f, n in counts.items() if n >= seen))}
        self.emit = np.zeros((len(self.names) + 1, 2))
        if not kept:
            return self
        flat = [self.rows(sorted(set(b))) for s, _ in kept for b in s]
        owner = np.repeat(np.arange(len(flat)), [len(r) for r in flat])
        index = np.asarray([i for r in flat for i in r], dtype=np.int64)
        size = np.asarray([len(s) for s, _ in kept])
        many, most = len(kept), int(size.max())
        gold = np.zeros((many, most), np.int64)
        mask = np.arange(most) < size[:, None]
        gold[mask] = [v for _, y in kept for v in y]
        hot = np.eye(2)[gold] * mask[:, :, None]
        weights = [self.emit, self.step, self.first]
        m1, m2 = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for t in range(1, rounds + 1):
            score = np.zeros((many, most, 2))
            emitted = np.stack([np.bincount(owner, self.emit[index, k], len(flat)) for k in (0, 1)], axis=1)
            score[mask] = emitted
            alpha, beta = np.zeros_like(score), np.zeros_like(score)
            alpha[:, 0] = score[:, 0] + self.first
            for i in range(1, most):
                moved = np.logaddexp.reduce(alpha[:, i - 1, :, None] + self.step, axis=1) + score[:, i]
                alpha[:, i] = np.where(mask[:, i, None], moved, alpha[:, i - 1])
            for i in range(most - 2, -1, -1):
                back = np.logaddexp.reduce(self.step + (score[:, i + 1] + beta[:, i + 1])[:, None, :], axis=2)
                beta[:, i] = np.where(mask[:, i + 1, None], back, 0.0)
            total = np.logaddexp.reduce(alpha[:, -1], axis=1)
            one = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
            pair = np.exp(alpha[:, :-1, :, None] + self.step + (score[:, 1:] + beta[:, 1:])[:, :, None, :]
                          - total[:, None, None, None]) * mask[:, 1:, None, None]
            wrong = (hot - one)[mask]
            grads = [np.stack([np.bincount(index, wrong[owner, k], len(self.emit)) for k in (0, 1)], axis=1),
                     np.einsum("nia,nib->ab", hot[:, :-1], hot[:, 1:]) - pair.sum((0, 1)),
                     (hot[:, 0] - one[:, 0]).sum(0)]
            for k, w in enumerate(weights):
                g = (grads[k] - penalty * w) / many
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.999 * m2[k] + 0.001 * g * g
                w += rate * (m1[k] / (1 - 0.9 ** t)) / (np.sqrt(m2[k] / (1 - 0.999 ** t)) + 1e-8)
        return self

    def decode(self, scores: list[tuple[float, float]]) -> list[int]:
        """Viterbi: the most probable labels for emission scores."""
        if not scores:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = scores[0][0] + self.first[0], scores[0][1] + self.first[1]
        back = []
        for x, y in scores[1:]:
            from_a = (a + s00 >= b + s10, a + s01 >= b + s11)
            a, b = max(a + s00, b + s10) + x, max(a + s01, b + s11) + y
            back.append(from_a)
        label = int(b > a)
        out = [label]
        for from_a in reversed(back):
            label = 0 if from_a[label] else 1
            out.append(label)
        return out[::-1]
