"""A linear-chain conditional random field over hashed features, and its decoding by Viterbi.

Tags are outside, begin and inside; inside follows begin or inside only. A token's score for a tag is the sum of the weights of
its features, so what a distinct token adds, as itself or as another's neighbour, is looked up once and gathered. Weights are fitted by
maximum likelihood with an L2 penalty (forward and backward sums over all windows at once, L-BFGS).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

OUT, BEGIN, INSIDE = range(3)
NEVER = -1e9
STEPS, MEMORY, ENOUGH = 80, 8, 1e-4
#: Half of it times the sum of squared weights is added to the loss.
RIDGE = 0.3


@dataclass
class Weights:
    """features: (ids, 3), id 0 stands for nothing; moves[a, b]: from a tag to the next; first: of a text's first tag."""

    features: np.ndarray
    moves: np.ndarray
    first: np.ndarray


def allowed(moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    moves, first = moves.copy(), first.copy()
    moves[OUT, INSIDE] = first[INSIDE] = NEVER
    return moves, first


def posteriors(scores: np.ndarray, there: np.ndarray, moves: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Of scores (windows, length, 3), padded at the right where not ``there``: (probabilities of tags, expected moves summed over
    all windows, sum of the log partition functions). Sums are scaled to one at each token."""
    n, length, _ = scores.shape
    top = scores.max(2, keepdims=True)
    e, m = np.exp(scores - top), np.exp(moves)
    ahead, back, scale = np.zeros_like(scores), np.ones_like(scores), np.ones((n, length))
    ahead[:, 0] = e[:, 0] * np.exp(first)
    for t in range(length):
        if t:
            ahead[:, t] = np.where(there[:, t, None], ahead[:, t - 1] @ m * e[:, t], ahead[:, t - 1])
        scale[:, t] = ahead[:, t].sum(1)
        ahead[:, t] /= scale[:, t, None]
    pairs = np.zeros((3, 3))
    for t in range(length - 1, 0, -1):
        own = np.where(there[:, t, None], e[:, t] * back[:, t] / scale[:, t, None], 0)
        back[:, t - 1] = np.where(there[:, t, None], own @ m.T, back[:, t])
        pairs += m * (ahead[:, t - 1].T @ own)
    return ahead * back * there[..., None], pairs, float((np.log(scale) + top[..., 0])[there].sum())


def minimised(loss, w: np.ndarray) -> np.ndarray:
    """Limited-memory quasi-Newton steps (two loops over the last MEMORY changes), halved until the loss falls enough."""
    value, slope = loss(w)
    moved, turned = [], []
    for _ in range(STEPS):
        way, used = slope.copy(), []
        for s, y in zip(reversed(moved), reversed(turned)):
            used.append((s @ way) / (y @ s))
            way -= used[-1] * y
        if moved:
            way *= (moved[-1] @ turned[-1]) / (turned[-1] @ turned[-1])
        for s, y, u in zip(moved, turned, reversed(used)):
            way += (u - (y @ way) / (y @ s)) * s
        step, fall = (1.0 if moved else 1 / max(1.0, np.abs(way).sum())), slope @ way
        for _ in range(30):
            new_value, new_slope = loss(w - step * way)
            if new_value <= value - 1e-4 * step * fall:
                break
            step /= 2
        else:
            return w
        s, y = -step * way, new_slope - slope
        w, done = w + s, value - new_value < ENOUGH * abs(new_value)
        if y @ s > 1e-10:
            moved, turned = [*moved, s][-MEMORY:], [*turned, y][-MEMORY:]
        value, slope = new_value, new_slope
        if done:
            break
    return w


def fit(features: np.ndarray, tags: np.ndarray, size: int, groups: list[tuple[int, int]]) -> Weights:
    """features: (windows, length, k) numbers below ``size``, 0: none; tags: (windows, length), -1 where a window is shorter.
    Columns of a group (from, to) repeat together, so each of its distinct rows is summed once."""
    there = tags >= 0
    n, length, k = features.shape
    gold = np.zeros((n, length, 3))
    gold[there] = np.eye(3)[tags[there]]
    moved = np.zeros((3, 3))
    both = there[:, 1:]
    np.add.at(moved, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    began = gold[:, 0].sum(0)
    used, flat = np.unique(features, return_inverse=True)
    flat = flat.reshape(-1, k)
    parts = [np.unique(flat[:, a:b], axis=0, return_inverse=True) for a, b in groups]
    parts = [(rows, at.reshape(-1)) for rows, at in parts]
    m = len(used)
    split = lambda w: (w[: 3 * m].reshape(m, 3), w[3 * m : 3 * m + 9].reshape(3, 3), w[3 * m + 9 :])

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        own, moves, first = split(w)
        scores = sum(own[rows].sum(1)[at] for rows, at in parts).reshape(n, length, 3)
        limits = allowed(moves, first)
        p, pairs, whole = posteriors(scores, there, *limits)
        right = (gold * scores).sum() + (moved * limits[0])[moved > 0].sum() + (began * limits[1])[began > 0].sum()
        off = (p - gold).reshape(-1, 3)
        slope = np.zeros_like(own)
        for rows, at in parts:
            for c in range(3):
                slope[:, c] += np.bincount(rows.ravel(), np.repeat(np.bincount(at, off[:, c], len(rows)), rows.shape[1]), m)
        slope[used == 0] = 0
        return whole - right + RIDGE / 2 * float(w @ w), np.concatenate([slope.ravel(), (pairs - moved).ravel(), p[:, 0].sum(0) - began]) + RIDGE * w

    w = minimised(loss, np.zeros(3 * m + 12))
    own, moves, first = split(w)
    table = np.zeros((size, 3), np.float32)
    table[used] = own
    table[0] = 0
    return Weights(table, *allowed(moves, first))


def certain(scores: np.ndarray, last: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Tokens that are outside on a best path whatever the others are.

    Take a path with another tag at a token, put outside there, and begin at the next one where that was inside: no other tag
    changes. If scores lose less by that than moves could ever, the new path is as good. ``last``: a text's last token."""
    worst, after = -np.inf, max(0.0, float((moves[INSIDE] - moves[BEGIN]).max()))
    for a in (OUT, BEGIN, INSIDE, None):
        for y in (BEGIN, INSIDE):
            for b in (OUT, BEGIN, INSIDE, None):
                enter = 0 if a is None else moves[a, y] - moves[a, OUT]
                leave = 0 if b is None else moves[y, b] - moves[OUT, BEGIN if b == INSIDE else b]
                leave += after if b == INSIDE else 0
                if enter > NEVER / 2:
                    worst = max(worst, enter + leave)
    swap = np.append(np.maximum(0, scores[1:, INSIDE] - scores[1:, BEGIN]), 0)
    swap[last] = 0
    return scores[:, OUT] - scores[:, 1:].max(1) - swap >= worst


def viterbi(scores: np.ndarray, begins: np.ndarray, weights: Weights) -> np.ndarray:
    """Tags of the best path through each text; scores: (tokens, 3) of all texts in a row, begins: each one's first token.

    Tokens that are certainly outside cut the texts into short runs, which are walked side by side."""
    n = len(scores)
    tags = np.zeros(n, np.int8)
    begins = begins[begins < n]
    if not n:
        return tags
    opens, last = np.zeros(n, bool), np.zeros(n, bool)
    opens[begins] = True
    last[:-1], last[-1] = opens[1:], True
    # a first token has its own scores for how a text begins; they bound it like any others
    own = scores.copy()
    own[opens] += weights.first
    sure = certain(own, last, weights.moves)
    left = np.flatnonzero(~sure)
    if not len(left):
        return tags
    new = np.ones(len(left), bool)
    new[1:] = (np.diff(left) > 1) | opens[left[1:]]
    at = left[new]
    size = np.diff(np.append(np.flatnonzero(new), len(left)))
    order = np.argsort(-size, kind="stable")
    at, size = at[order], size[order]
    came = np.zeros((int(size.sum()), 3), np.int8)
    place = np.concatenate(([0], np.cumsum(size)))
    best = own[at] + np.where(opens[at][:, None], 0, weights.moves[OUT])
    final = best.copy()
    for t in range(1, int(size[0]) if len(size) else 0):
        on = int(np.searchsorted(-size, -t, side="left"))
        step = best[:on, :, None] + weights.moves
        came[place[:on] + t] = step.argmax(1)
        best = step.max(1) + own[at[:on] + t]
        final[:on] = best
    ends = at + size - 1
    final = final + np.where(last[ends][:, None], 0, weights.moves[:, OUT])
    state = final.argmax(1)
    for t in range(int(size[0]) - 1, -1, -1):
        on = int(np.searchsorted(-size, -t, side="left"))
        tags[at[:on] + t] = state[:on]
        if t:
            state[:on] = came[place[:on] + t, state[:on]]
    return tags
