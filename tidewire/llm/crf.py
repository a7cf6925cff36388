"""A linear-chain conditional random field with two labels, in numpy.

Items (words, lines) carry feature ids. The emission of an item is the sum of its own features' weights and of its two
neighbours' features under weights of their own; transitions are a 2x2 table. Many sequences are handled at once: they are
cut into blocks of ``STEPS`` items whose 2x2 transfer matrices are multiplied side by side, block products are chained per
sequence, and a second pass fills in the marginals. The number of numpy calls depends on ``STEPS`` and the number of
blocks of the longest sequence, never on the number of items.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEPS = 32
LIMIT = 30.0  # emissions beyond this are as good as certain and are cut off to keep the products finite


@dataclass
class Model:
    """``own``, ``left``, ``right``: weights by feature id for the item and its neighbours; ``move``: transitions."""

    own: np.ndarray
    left: np.ndarray
    right: np.ndarray
    move: np.ndarray  # move[i, j]: from label i to label j
    bias: float


def emissions(model: Model, features: np.ndarray, items: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Emission of each item. ``features``: a row of ids per distinct kind of item; ``items``: the kind of each item;
    ``first``/``last``: whether an item begins or ends its sequence."""
    own, left, right = (w[features].sum(axis=1)[items] for w in (model.own, model.left, model.right))
    return combined(own, left, right, model.bias, first, last)


def combined(own: np.ndarray, left: np.ndarray, right: np.ndarray, bias: float, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Emissions from each item's weight for itself, for the item after it (``left``) and the item before it (``right``)."""
    out = own + bias
    out[1:] += np.where(first[1:], 0, left[:-1])
    out[:-1] += np.where(last[:-1], 0, right[1:])
    return np.clip(out, -LIMIT, LIMIT)


def bounds_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flags of the first and the last item of each sequence (empty sequences have none)."""
    ends = np.cumsum(lengths)
    first, last = np.zeros(int(ends[-1]) if len(ends) else 0, bool), np.zeros(int(ends[-1]) if len(ends) else 0, bool)
    full = lengths > 0
    first[(ends - lengths)[full]] = True
    last[ends[full] - 1] = True
    return first, last


def marginals(emission: np.ndarray, lengths: np.ndarray, move: np.ndarray,
              counted: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(label 1) of each item, expected transition counts (2x2; zeros unless ``counted``), and each sequence's log partition."""
    lengths = np.asarray(lengths, dtype=np.int64)
    n_blocks = -(-lengths // STEPS)
    total = int(n_blocks.sum())
    logz = np.zeros(len(lengths))
    if not total:
        return np.zeros(0), np.zeros((2, 2)), logz
    block0 = np.cumsum(n_blocks) - n_blocks
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(emission)) - np.repeat(starts, lengths)
    row, col = np.repeat(block0, lengths) + place // STEPS, place % STEPS
    table = np.zeros((total, STEPS))
    table[row, col] = emission
    live = np.zeros((total, STEPS), bool)
    live[row, col] = True
    begins = np.zeros(total, bool)
    begins[block0[n_blocks > 0]] = True

    weight = np.exp(move - move.max())
    shift = move.max()
    # each item's potentials (1, e), scaled so that the larger is 1
    high = np.maximum(table, 0)
    p0, p1 = np.exp(-high), np.exp(table - high)
    # products of the blocks' transfer matrices; the first item of a sequence has no transition
    product = np.broadcast_to(np.eye(2), (total, 2, 2)).copy()
    scale = np.zeros(total)
    for t in range(STEPS):
        step = product @ weight
        if t == 0:
            step[begins] = product[begins]
        step[:, :, 0] *= p0[:, t, None]
        step[:, :, 1] *= p1[:, t, None]
        product = np.where(live[:, t, None, None], step, product)
        peak = product.max(axis=(1, 2))
        product /= peak[:, None, None]
        scale += np.log(peak)
    scale += (high * live).sum(axis=1) + shift * (live.sum(axis=1) - begins)
    # chain the blocks of each sequence, forwards and backwards; sequences with most blocks first
    order = np.argsort(-n_blocks, kind="stable")
    sizes = n_blocks[order]
    ahead = np.ones((total, 2))
    behind = np.ones((total, 2))
    state, log_state = np.ones((len(lengths), 2)), np.zeros(len(lengths))
    for b in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -b, side="left"))
        at = block0[order[:n]] + b
        ahead[at] = state[:n]
        new = np.einsum("ni,nij->nj", state[:n], product[at])
        norm = new.sum(axis=1)
        state[:n] = new / norm[:, None]
        log_state[:n] += np.log(norm) + scale[at]
    # the first block is entered with a state of (1, 1) whose labels are both the first item's: no transition was taken
    logz[order] = log_state
    state = np.ones((len(lengths), 2))
    for b in range(int(sizes[0]) - 1, -1, -1):
        n = int(np.searchsorted(-sizes, -b, side="left"))
        at = block0[order[:n]] + b
        behind[at] = state[:n]
        new = np.einsum("nij,nj->ni", product[at], state[:n])
        state[:n] = new / new.sum(axis=1, keepdims=True)
    # inside the blocks: forward states before each item's potential, then backward
    before = np.empty((STEPS, total, 2))
    state = ahead
    for t in range(STEPS):
        step = state @ weight
        if t == 0:
            step[begins] = 1.0
        before[t] = step
        new = step * np.stack([p0[:, t], p1[:, t]], axis=1)
        new /= new.sum(axis=1, keepdims=True)
        state = np.where(live[:, t, None], new, state)
    counts = np.zeros((2, 2))
    out = np.empty((total, STEPS))
    state = behind
    for t in range(STEPS - 1, -1, -1):
        here = np.stack([p0[:, t], p1[:, t]], axis=1) * state  # potential times what follows
        both = before[t] * here
        out[:, t] = both[:, 1] / both.sum(axis=1)
        if counted:
            entered = live[:, t] & ~(begins if t == 0 else np.zeros(total, bool))
            came = (ahead if t == 0 else _after(before[t - 1], p0[:, t - 1], p1[:, t - 1]))[entered]
            pair = came[:, :, None] * weight * here[entered][:, None, :]
            counts += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        new = here @ weight.T
        new /= new.sum(axis=1, keepdims=True)
        if t:
            state = np.where(live[:, t, None], new, state)
    return out[row, col], counts, logz


def _after(before: np.ndarray, p0: np.ndarray, p1: np.ndarray) -> np.ndarray:
    state = before * np.stack([p0, p1], axis=1)
    return state / state.sum(axis=1, keepdims=True)


def fit(features: np.ndarray, items: np.ndarray, lengths: np.ndarray, labels: np.ndarray, n_features: int,
        weights: np.ndarray | None = None, rounds: int = 60, rate: float = 0.15, penalty: float = 1e-3) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam on the whole sample. ``weights``: of each sequence."""
    lengths = np.asarray(lengths, dtype=np.int64)
    first, last = bounds_of(lengths)
    each = np.repeat(np.ones(len(lengths)) if weights is None else weights, lengths)
    labels = labels.astype(np.float64)
    pairs = ~first[1:]
    observed = np.zeros((2, 2))
    a, b = labels[:-1][pairs].astype(int), labels[1:][pairs].astype(int)
    np.add.at(observed, (a, b), each[1:][pairs])
    rate_1 = np.clip((labels * each).sum() / max(each.sum(), 1), 1e-4, 1 - 1e-4)
    model = Model(*(np.zeros(n_features) for _ in range(3)), np.zeros((2, 2)), float(np.log(rate_1 / (1 - rate_1))))
    total = max(each.sum(), 1.0)
    moments = [[0.0, 0.0] for _ in range(5)]
    uniform = weights is None
    for step in range(1, rounds + 1):
        p, counts, _ = marginals(emissions(model, features, items, first, last), lengths, model.move)
        rest = (labels - p) * each
        grads = []
        for side in (0, 1, 2):
            if side == 0:
                by_kind = np.bincount(items, rest, len(features))
            elif side == 1:
                by_kind = np.bincount(items[:-1][pairs], rest[1:][pairs], len(features))
            else:
                by_kind = np.bincount(items[1:][pairs], rest[:-1][pairs], len(features))
            grads.append(np.bincount(features.ravel(), np.repeat(by_kind, features.shape[1]), n_features) / total)
        # with weighted sequences the transition counts are matched on the unweighted sample's scale
        grads.append((observed - counts) / total if uniform else (observed - counts * (observed.sum() / max(counts.sum(), 1e-9))) / total)
        grads.append(np.array(rest.sum() / total))
        values = [model.own, model.left, model.right, model.move, np.array(model.bias)]
        for k, (grad, value) in enumerate(zip(grads, values)):
            if k < 4:
                grad = grad - penalty * value / np.sqrt(total)
            m, v = moments[k]
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            moments[k] = [m, v]
            move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
            if k == 4:
                model.bias = float(value + move)
            else:
                value += move
    return model


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None, penalty: float = 1e-2,
                 rounds: int = 50) -> np.ndarray:
    """Coefficients (the last is the intercept) of a penalised logistic regression, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.ones(len(x)) if weights is None else weights
    beta, ridge = np.zeros(x.shape[1]), penalty * np.eye(x.shape[1])
    for _ in range(rounds):
        p = logistic(x @ beta)
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (w * (y - p)) - ridge @ beta)
        beta += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
