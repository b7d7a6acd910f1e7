"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Characters enter as classes: digits, small and capital letters are one class
each, and the signs that personal data are written with stand for themselves.
"""

from __future__ import annotations

import numpy as np

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # none, then begin and inside of each kind
HIDDEN = 24
NEVER = -1e4
SIGNS = "@.+-() _%,:/=\"'#*$&!|\n"
PAD, DIGIT, LOWER, UPPER, LETTER, OTHER = range(6)
CLASSES = 6 + len(SIGNS)

_ASCII = np.full(128, OTHER, np.int8)
_ASCII[ord("0") : ord("9") + 1] = DIGIT
_ASCII[ord("a") : ord("z") + 1] = LOWER
_ASCII[ord("A") : ord("Z") + 1] = UPPER
for _i, _c in enumerate(SIGNS):
    _ASCII[ord(_c)] = 6 + _i


def classes(text: str) -> np.ndarray:
    """The class of each character; any character beyond ASCII is a letter."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, _ASCII[np.minimum(codes, 127)], LETTER).astype(np.int8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def allowed() -> np.ndarray:
    """0 where a tag may follow another, else ``NEVER``: inside only goes on its own kind."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for tag in range(2, TAGS, 2):
        out[:, tag] = NEVER
        out[tag - 1, tag] = out[tag, tag] = 0
    return out


def start(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.2).astype(np.float32)
    net = {"out": draw(2 * HIDDEN, TAGS), "bias": np.zeros(TAGS, np.float32), "step": np.zeros((TAGS, TAGS), np.float32)}
    for way in ("f", "b"):
        net[f"x{way}"] = draw(CLASSES, 4 * HIDDEN)
        net[f"x{way}"][:, HIDDEN : 2 * HIDDEN] += 1  # remember at first
        net[f"h{way}"] = draw(HIDDEN, 4 * HIDDEN)
    return net


def _run(ids: np.ndarray, x: np.ndarray, h: np.ndarray, keep: bool):
    """States of one direction over (time, batch) classes; with ``keep``, the parts that training needs."""
    steps, batch = ids.shape
    hidden, cell = np.zeros((batch, HIDDEN), np.float32), np.zeros((batch, HIDDEN), np.float32)
    states, parts = np.empty((steps, batch, HIDDEN), np.float32), []
    for t in range(steps):
        gates = x[ids[t]] + hidden @ h
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        if keep:
            parts.append((hidden, cell, i, f, o, g))
        cell = f * cell + i * g
        squashed = np.tanh(cell)
        hidden = o * squashed
        states[t] = hidden
        if keep:
            parts[-1] += (squashed,)
    return states, parts


def _back(ids: np.ndarray, h: np.ndarray, parts: list, slope: np.ndarray):
    """Gradients of one direction from those of its states."""
    dx, dh = np.zeros((CLASSES, 4 * HIDDEN), np.float32), np.zeros_like(h)
    later = np.zeros_like(slope[0])
    later_cell = np.zeros_like(slope[0])
    for t in range(len(ids) - 1, -1, -1):
        hidden, cell, i, f, o, g, squashed = parts[t]
        dhidden = slope[t] + later
        dcell = later_cell + dhidden * o * (1 - squashed**2)
        gates = np.concatenate(
            [dcell * g * i * (1 - i), dcell * cell * f * (1 - f), dhidden * squashed * o * (1 - o), dcell * i * (1 - g**2)], 1
        )
        np.add.at(dx, ids[t], gates)
        dh += hidden.T @ gates
        later, later_cell = gates @ h.T, dcell * f
    return dx, dh


def emissions(net: dict, ids: np.ndarray) -> np.ndarray:
    """Scores (batch, time, tag) of windows of classes (batch, time)."""
    turned = np.ascontiguousarray(ids.T)
    forward, _ = _run(turned, net["xf"], net["hf"], False)
    backward, _ = _run(turned[::-1], net["xb"], net["hb"], False)
    both = np.concatenate([forward, backward[::-1]], 2)
    return (both @ net["out"] + net["bias"]).transpose(1, 0, 2)


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def loss_and_slopes(net: dict, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Mean negative log likelihood of tag rows under the CRF, and its gradients."""
    ids, tags = np.ascontiguousarray(ids.T), np.ascontiguousarray(tags.T)
    steps, batch = ids.shape
    forward, kept_f = _run(ids, net["xf"], net["hf"], True)
    backward, kept_b = _run(ids[::-1], net["xb"], net["hb"], True)
    both = np.concatenate([forward, backward[::-1]], 2)
    scores = both @ net["out"] + net["bias"]
    move = net["step"] + allowed()
    first = np.where(np.arange(TAGS) % 2 == 0, NEVER, 0).astype(np.float32)
    first[0] = 0
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[0] = first + scores[0]
    for t in range(1, steps):
        alpha[t] = _sum_exp(alpha[t - 1][:, :, None] + move, 1) + scores[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _sum_exp(move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    whole = _sum_exp(alpha[-1], 1)
    slope = np.exp(alpha + beta - whole[:, None])
    row = np.arange(batch)
    dmove = np.zeros((TAGS, TAGS), np.float32)
    gold = first[tags[0]] + scores[0, row, tags[0]]
    for t in range(steps):
        slope[t, row, tags[t]] -= 1
        if t:
            pair = alpha[t - 1][:, :, None] + move + (scores[t] + beta[t])[:, None, :] - whole[:, None, None]
            dmove += np.exp(pair).sum(0)
            np.add.at(dmove, (tags[t - 1], tags[t]), -1)
            gold = gold + move[tags[t - 1], tags[t]] + scores[t, row, tags[t]]
    slope /= batch
    out = {
        "out": np.einsum("tbh,tbk->hk", both, slope),
        "bias": slope.sum((0, 1)),
        "step": dmove / batch,
    }
    states = slope @ net["out"].T
    out["xf"], out["hf"] = _back(ids, net["hf"], kept_f, states[:, :, :HIDDEN])
    out["xb"], out["hb"] = _back(ids[::-1], net["hb"], kept_b, states[::-1, :, HIDDEN:])
    return float((whole - gold).mean()), out


def train(ids: np.ndarray, tags: np.ndarray, passes: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 7) -> dict:
    """Adam over shuffled batches of windows (row, time); the same rows give the same net."""
    net = start(seed)
    mean = {k: np.zeros_like(v) for k, v in net.items()}
    square = {k: np.zeros_like(v) for k, v in net.items()}
    rng, count = np.random.default_rng(seed), 0
    total = passes * max(1, len(ids) // batch)
    for _ in range(passes):
        order = rng.permutation(len(ids))
        for at in range(0, len(order) - batch + 1, batch) if len(order) >= batch else [0]:
            rows = order[at : at + batch]
            _, slopes = loss_and_slopes(net, ids[rows], tags[rows])
            size = np.sqrt(sum(float((s**2).sum()) for s in slopes.values()))
            count += 1
            pace = rate * (1 - 0.9 * count / (total + 1))
            for k, s in slopes.items():
                s = s * min(1.0, 5 / (size + 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * s
                square[k] = 0.999 * square[k] + 0.001 * s**2
                net[k] -= (
                    pace * (mean[k] / (1 - 0.9**count)) / (np.sqrt(square[k] / (1 - 0.999**count)) + 1e-8)
                ).astype(np.float32)
    return net


def best_tags(net: dict, scores: np.ndarray) -> np.ndarray:
    """The best row of tags of each (batch, time, tag) row of scores."""
    batch, steps, _ = scores.shape
    move = net["step"] + allowed()
    best = scores[:, 0] + np.where((np.arange(TAGS) % 2 == 0) & (np.arange(TAGS) > 0), NEVER, 0)
    came = np.zeros((steps, batch, TAGS), np.int8)
    for t in range(1, steps):
        paths = best[:, :, None] + move
        came[t] = paths.argmax(1)
        best = paths.max(1) + scores[:, t]
    out = np.empty((batch, steps), np.int8)
    out[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = came[t][np.arange(batch), out[:, t]]
    return out
