"""Linear-chain conditional random field over two tags (clean, toxic), on many sequences at once."""

from __future__ import annotations

import numpy as np

BLOCK = 64
AT_ONCE = 2048  # blocks whose messages are held at the same time


class Chains:
    """Sequences cut into blocks of ``BLOCK`` tokens, so that all blocks move in step.

    Messages cross the blocks of a sequence by the products of their transfer
    matrices; marginals are those of the whole sequence, not of the block.
    """

    def __init__(self, lengths: np.ndarray):
        lengths = np.asarray(lengths, dtype=np.int64)
        self.per = -(-lengths // BLOCK)
        self.first = np.cumsum(self.per) - self.per
        self.blocks = int(self.per.sum())
        begin = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(begin, lengths)
        self.block = np.repeat(self.first, lengths) + place // BLOCK
        self.step = place % BLOCK
        self.valid = np.zeros((BLOCK, self.blocks), dtype=bool)
        self.valid[self.step, self.block] = True

    def marginals(self, score: np.ndarray, trans: np.ndarray, weight: np.ndarray | None = None):
        """P(toxic) of each token and the expected counts of the four transitions.

        ``score`` is each token's log weight of toxic against clean; the state
        before a sequence is clean.  ``weight`` weighs the counts by sequence.
        """
        m = np.exp(trans)
        x = np.ones((BLOCK, self.blocks))
        x[self.step, self.block] = np.exp(np.clip(score, -30, 30))
        parts = [slice(lo, lo + AT_ONCE) for lo in range(0, self.blocks, AT_ONCE)]
        p = np.concatenate([_products(m, x[:, s], self.valid[:, s]) for s in parts], axis=2) if parts else np.zeros((2, 2, 0))
        head = np.zeros((2, self.blocks))
        tail = np.zeros((2, self.blocks))
        last = self.first + self.per - 1
        for k in range(int(self.per.max(initial=0))):
            at = self.first[self.per > k] + k
            if k == 0:
                head[0, at] = 1.0
            else:
                a, q = head[:, at - 1], p[:, :, at - 1]
                new = np.stack([a[0] * q[0, 0] + a[1] * q[1, 0], a[0] * q[0, 1] + a[1] * q[1, 1]])
                head[:, at] = new / new.sum(axis=0)
            at = last[self.per > k] - k
            if k == 0:
                tail[:, at] = 0.5
            else:
                b, q = tail[:, at + 1], p[:, :, at + 1]
                new = np.stack([q[0, 0] * b[0] + q[0, 1] * b[1], q[1, 0] * b[0] + q[1, 1] * b[1]])
                tail[:, at] = new / new.sum(axis=0)
        each = self.valid if weight is None else self.valid * np.repeat(weight, self.per)
        toxic, counts = np.zeros((BLOCK, self.blocks)), np.zeros((2, 2))
        for s in parts:
            toxic[:, s], some = _inside(m, x[:, s], self.valid[:, s], head[:, s], tail[:, s], each[:, s])
            counts += some
        return toxic[self.step, self.block], counts


def _inside(m, x, valid, head, tail, each):
    """P(toxic) at every step of some blocks, and their expected transitions, from the messages at their ends."""
    ahead = np.zeros((BLOCK + 1, 2, x.shape[1]))  # message before each step
    ahead[0] = head
    for j in range(BLOCK):
        a, ok = ahead[j], valid[j]
        clean = a[0] * m[0, 0] + a[1] * m[1, 0]
        toxic = (a[0] * m[0, 1] + a[1] * m[1, 1]) * x[j]
        total = clean + toxic
        ahead[j + 1, 0] = np.where(ok, clean / total, a[0])
        ahead[j + 1, 1] = np.where(ok, toxic / total, a[1])
    behind = np.zeros((BLOCK + 1, 2, x.shape[1]))  # message after each step
    behind[BLOCK] = tail
    for j in range(BLOCK - 1, -1, -1):
        b, ok = behind[j + 1], valid[j]
        clean = m[0, 0] * b[0] + m[0, 1] * x[j] * b[1]
        toxic = m[1, 0] * b[0] + m[1, 1] * x[j] * b[1]
        total = clean + toxic
        behind[j, 0] = np.where(ok, clean / total, b[0])
        behind[j, 1] = np.where(ok, toxic / total, b[1])
    both = ahead[1:] * behind[1:]
    pairs = np.empty((2, 2, *x.shape))
    for i in (0, 1):
        for j in (0, 1):
            pairs[i, j] = ahead[:-1, i] * m[i, j] * (x if j else 1.0) * behind[1:, j]
    pairs /= pairs.sum(axis=(0, 1))
    return both[:, 1] / both.sum(axis=1), (pairs * each).sum(axis=(2, 3))


def _products(m: np.ndarray, x: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Product of the transfer matrices of each block."""
    p = np.zeros((2, 2, x.shape[1]))
    p[0, 0] = p[1, 1] = 1.0
    for j in range(BLOCK):
        new = np.empty_like(p)
        for i in (0, 1):
            new[i, 0] = p[i, 0] * m[0, 0] + p[i, 1] * m[1, 0]
            new[i, 1] = (p[i, 0] * m[0, 1] + p[i, 1] * m[1, 1]) * x[j]
        new /= new.sum(axis=(0, 1))
        p = np.where(valid[j], new, p)
    return p


def token_score(bins: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Log weight of toxic for each token from its bin and its neighbours' bins.

    ``weights`` is (3, bins): the token's own, the one before, the one after;
    ``starts`` marks the first token of each sequence.
    """
    return sum(weights[k][view] for k, view in enumerate(neighbours(bins, starts)))


def neighbours(bins: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Bins of each token, of the token before and of the one after (0 beyond the ends)."""
    before = np.concatenate([[0], bins[:-1]]) if len(bins) else bins
    after = np.concatenate([bins[1:], [0]]) if len(bins) else bins
    before = np.where(starts, 0, before)
    after = np.where(np.concatenate([starts[1:], [True]]) if len(bins) else starts, 0, after)
    return [bins, before, after]


def fit(bins: np.ndarray, tags: np.ndarray, lengths: np.ndarray, size: int, weight: np.ndarray | None = None,
        rounds: int = 100, penalty: float = 0.5, rate: float = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights (3, size) and log transitions (2, 2) of greatest penalised
    likelihood (AdaGrad); ``weight`` is how often each sequence counts."""
    weight = np.ones(len(lengths)) if weight is None else np.asarray(weight, dtype=float)
    each = np.repeat(weight, lengths)
    chains = Chains(lengths)
    starts = np.zeros(len(bins), dtype=bool)
    lengths = np.asarray(lengths)
    starts[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    views = neighbours(bins, starts)
    weights, trans = np.zeros((3, size)), np.zeros((2, 2))
    before = np.where(starts, 0, np.concatenate([[0], tags[:-1]]))
    seen = np.bincount(before * 2 + tags, each, minlength=4).reshape(2, 2)
    square_w, square_t = np.full_like(weights, 1e-6), np.full_like(trans, 1e-6)
    for _ in range(rounds):
        marginal, expected = chains.marginals(token_score(bins, starts, weights), trans, weight)
        gap = (tags - marginal) * each
        g = np.stack([np.bincount(v, gap, minlength=size) for v in views]) - penalty * weights
        h = seen - expected - penalty * trans
        h[0, 0] = 0.0  # the scale is fixed by clean-to-clean
        square_w += g * g
        square_t += h * h
        weights += rate * g / np.sqrt(square_w)
        trans += rate * h / np.sqrt(square_t)
    return weights, trans
