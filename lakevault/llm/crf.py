"""A linear-chain conditional random field in numpy: forward-backward over many chains at once, and fitting.

Positions of all chains lie one after the other; ``lengths`` says how long each chain is (1 at least). Chains
are walked side by side, longest first, so a step handles one position of every chain that still runs.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np


class Chains:
    """How chains of given lengths are walked."""

    def __init__(self, lengths: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        self.starts = (np.cumsum(lengths) - lengths)[order]
        longest = int(lengths.max()) if len(lengths) else 0
        # Chains that have a position t, for each t.
        self.running = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
        self.size = int(lengths.sum())
        follows = np.ones(self.size, bool)
        follows[self.starts] = False
        self.follows = np.flatnonzero(follows)  # positions that have one before them


def forward_backward(potentials: np.ndarray, chains: Chains, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Scaled forward and backward values of each position, and the log of all chains' partition functions.

    ``potentials`` are positive emission factors (positions × labels), ``moves`` positive transition factors and
    ``first`` those of a chain's first label. Forward times backward, made to sum to 1, are the marginals.
    """
    forward, backward = np.empty_like(potentials), np.ones_like(potentials)
    logs = 0.0
    now = None
    for t, running in enumerate(chains.running):
        at = chains.starts[:running] + t
        now = potentials[at] * (first if now is None else now[:running] @ moves)
        scale = now.sum(1, keepdims=True)
        now /= scale
        logs += float(np.log(scale).sum())
        forward[at] = now
    after = None
    for t in range(len(chains.running) - 1, 0, -1):
        at = chains.starts[: chains.running[t]] + t
        weight = potentials[at]
        if after is not None:
            weight[: len(after)] *= after
        after = weight @ moves.T
        after /= after.sum(1, keepdims=True)
        backward[at - 1] = after
    return forward, backward, logs


def marginals(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Probability of each label at each position; ``scores``, ``moves`` and ``first`` are logarithms."""
    if not len(scores):
        return np.empty_like(scores)
    potentials = np.exp(scores - scores.max(1, keepdims=True))
    forward, backward, _ = forward_backward(potentials, Chains(lengths), np.exp(moves).astype(scores.dtype), np.exp(first).astype(scores.dtype))
    forward *= backward
    forward /= forward.sum(1, keepdims=True)
    return forward


def fit(
    emit: Callable[[np.ndarray], np.ndarray], back: Callable[[np.ndarray], np.ndarray], weights: np.ndarray, labels: np.ndarray,
    lengths: np.ndarray, rounds: int, rate: float, decay: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Emission weights, transitions and first-label scores of the highest penalised likelihood (Adam, all chains per round).

    ``emit`` turns weights into scores of all positions, ``back`` a gradient of the scores into one of the weights.
    """
    kinds, chains, size = weights.shape[-1], Chains(lengths), max(1, len(labels))
    wanted = np.eye(kinds)[labels]
    follows, starts = chains.follows, chains.starts
    moved = np.zeros((kinds, kinds))
    np.add.at(moved, (labels[follows - 1], labels[follows]), 1.0)
    parts = [weights.astype(float), np.zeros((kinds, kinds)), np.zeros(kinds)]
    mean, square = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, rounds + 1):
        scores = emit(parts[0])
        potentials = np.exp(scores - scores.max(1, keepdims=True))
        moves, first = np.exp(parts[1]), np.exp(parts[2])
        forward, backward, _ = forward_backward(potentials, chains, moves, first)
        state = forward * backward
        state /= state.sum(1, keepdims=True)
        ahead = potentials[follows] * backward[follows]
        pairs = forward[follows - 1]
        norm = ((pairs @ moves) * ahead).sum(1, keepdims=True)
        expected = moves * (pairs.T @ (ahead / norm))
        gradients = [back(wanted - state) / size, (moved - expected) / size, (wanted[starts] - state[starts]).sum(0) / size]
        for k, gradient in enumerate(gradients):
            gradient -= decay * parts[k]
            mean[k] = 0.9 * mean[k] + 0.1 * gradient
            square[k] = 0.99 * square[k] + 0.01 * gradient**2
            parts[k] += rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return parts[0], parts[1], parts[2]
