"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Gates are piecewise linear, so a step is a table look-up, a small product and
clips. Arrays are (feature, window): a step works on one character of all
windows. Weights and arithmetic are 32-bit; the same weights and windows give
the same spans in every task.
"""

from __future__ import annotations

import numpy as np

from galewatch.llm.pii_rules import KINDS

HIDDEN = 10
TAGS = 1 + len(KINDS)  # 0: no personal data
# Characters told apart: printable ASCII, line ends, letters beyond ASCII, all else; 0 is padding.
VOCABULARY = 99


def code_table() -> np.ndarray:
    """Character number of each code point below 65536; higher ones are like the last."""
    table = np.full(1 << 16, 98, np.uint8)
    table[0xAA:0x2000] = 97
    table[32:127] = np.arange(1, 96)
    table[[9, 10, 13]] = 96
    return table


CODES = code_table()


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CODES[np.minimum(points, 0xFFFF)]


def fresh(seed: int) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    weights = {}
    for way in "fb":
        table = random.normal(0, 0.3, (4 * HIDDEN, VOCABULARY))
        table[HIDDEN : 2 * HIDDEN] += 0.3  # remember at first
        weights[f"x{way}"] = table
        weights[f"h{way}"] = random.normal(0, 0.3 / np.sqrt(HIDDEN), (4 * HIDDEN, HIDDEN))
        weights[f"o{way}"] = random.normal(0, 0.5 / np.sqrt(HIDDEN), (TAGS, HIDDEN))
    weights["bias"] = np.zeros((TAGS, 1))
    weights["moves"] = np.zeros((TAGS, TAGS))
    return {name: w.astype(np.float32) for name, w in weights.items()}


H1, H2, H3 = HIDDEN, 2 * HIDDEN, 3 * HIDDEN


def step(gates: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gates in, forget, out (0 to 1) and candidate (-1 to 1), clipped in place; the new cell and output."""
    np.clip(gates[:H3], 0, 1, out=gates[:H3])
    np.clip(gates[H3:], -1, 1, out=gates[H3:])
    cell = gates[H1:H2] * cell
    cell += gates[:H1] * gates[H3:]
    return cell, gates[H2:H3] * np.clip(cell, -1, 1)


def start_table(weights: dict[str, np.ndarray], way: str) -> np.ndarray:
    table = weights[f"x{way}"].copy()
    table[:H3] += 0.5
    return table


def emissions(weights: dict[str, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """(position, tag, window) scores; ``codes``: (position, window). As ``step``, without new arrays on the way."""
    length, width = codes.shape
    out = np.empty((length, TAGS, width), np.float32)
    gates, again = np.empty((4 * HIDDEN, width), np.float32), np.empty((4 * HIDDEN, width), np.float32)
    new, read_out = np.empty((HIDDEN, width), np.float32), np.empty((TAGS, width), np.float32)
    soft, candidate = gates[:H3], gates[H3:]
    enter, forget, leave = gates[:H1], gates[H1:H2], gates[H2:H3]
    for way in "fb":
        table, recur, read = start_table(weights, way), weights[f"h{way}"], weights[f"o{way}"]
        cell, hidden = np.zeros((HIDDEN, width), np.float32), np.zeros((HIDDEN, width), np.float32)
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            np.take(table, codes[t], axis=1, out=gates, mode="clip")
            np.add(gates, np.dot(recur, hidden, out=again), out=gates)
            np.clip(soft, 0, 1, out=soft)
            np.clip(candidate, -1, 1, out=candidate)
            np.multiply(cell, forget, out=cell)
            np.add(cell, np.multiply(enter, candidate, out=new), out=cell)
            np.multiply(leave, np.clip(cell, -1, 1, out=new), out=hidden)
            if way == "f":
                np.dot(read, hidden, out=out[t])
            else:
                np.add(out[t], np.dot(read, hidden, out=read_out), out=out[t])
    out += weights["bias"]
    return out


def best_paths(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """(position, window) tags of the best path."""
    length, tags, width = scores.shape
    back = np.empty((length, tags, width), np.uint8)
    total = scores[0]
    best, way = np.empty_like(total), np.empty_like(total)
    for t in range(1, length):
        # The first of equal ways wins, as it would with argmax.
        for to in range(tags):
            np.add(total[0], moves[0, to], out=best[to])
        back[t] = 0
        for start in range(1, tags):
            np.add(total[start], moves[start][:, None], out=way)
            np.putmask(back[t], way > best, start)
            np.maximum(best, way, out=best)
        total = best + scores[t]
    path = np.empty((length, width), np.uint8)
    path[-1] = total.argmax(0)
    every = np.arange(width)
    for t in range(length - 1, 0, -1):
        path[t - 1] = back[t][path[t], every]
    return path


def hopeless(scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Windows whose best path is surely without personal data.

    A run of m other tags has m + 1 moves at most that differ from staying
    outside, each better by the best move's lead; so its tags must make up for
    1 + 1 / m leads each, and for two if it has one character.
    """
    most = (scores[:, 1:] - scores[:, :1]).max(axis=(0, 1))
    return most + 2 * max(0.0, float(moves.max() - moves[0, 0])) < 0


# ---- training ---------------------------------------------------------------


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores: np.ndarray, moves: np.ndarray, tags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients, for scores and moves, of the mean negative log likelihood of the tags."""
    length, kinds, width = scores.shape
    ahead, behind = np.empty_like(scores), np.empty_like(scores)
    ahead[0], behind[-1] = scores[0], 0
    for t in range(1, length):
        ahead[t] = log_sum(ahead[t - 1][:, None] + moves[:, :, None], 0) + scores[t]
        back = length - 1 - t
        behind[back] = log_sum(moves[:, :, None] + (scores[back + 1] + behind[back + 1])[None], 1)
    whole = log_sum(ahead[-1], 0)
    right = tags[:, None, :] == np.arange(kinds)[None, :, None]
    of_scores = np.exp(ahead + behind - whole) - right
    pairs = ahead[:-1, :, None] + moves[None, :, :, None] + (scores[1:] + behind[1:])[:, None] - whole
    of_moves = np.exp(pairs).sum(axis=(0, 3))
    np.subtract.at(of_moves, (tags[:-1].ravel(), tags[1:].ravel()), 1)
    return of_scores / width, of_moves / width


def gradients(weights: dict[str, np.ndarray], codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
    length, width = codes.shape
    kept, scores = {}, np.zeros((length, TAGS, width), np.float32) + weights["bias"]
    for way in "fb":
        order = list(range(length)) if way == "f" else list(range(length - 1, -1, -1))
        table, recur, read = start_table(weights, way), weights[f"h{way}"], weights[f"o{way}"]
        cell, hidden = np.zeros((HIDDEN, width), np.float32), np.zeros((HIDDEN, width), np.float32)
        past = []
        for t in order:
            gates = table[:, codes[t]] + recur @ hidden
            raw = gates.copy()
            before, was = cell, hidden
            cell, hidden = step(gates, cell)
            past.append((t, raw, gates, before, was, cell, hidden))
            scores[t] += read @ hidden
        kept[way] = past
    of_scores, of_moves = crf_gradient(scores, weights["moves"], tags)
    out = {"moves": of_moves, "bias": of_scores.sum(axis=(0, 2))[:, None]}
    for way in "fb":
        recur, read = weights[f"h{way}"], weights[f"o{way}"]
        of_x, of_h, of_o = np.zeros_like(weights[f"x{way}"]), np.zeros_like(recur), np.zeros_like(read)
        of_cell, of_hidden = np.zeros((HIDDEN, width), np.float32), np.zeros((HIDDEN, width), np.float32)
        for t, raw, gates, before, was, cell, hidden in reversed(kept[way]):
            of_o += of_scores[t] @ hidden.T
            of_hidden = of_hidden + read.T @ of_scores[t]
            bent = np.clip(cell, -1, 1)
            of_cell = of_cell + of_hidden * gates[H2:H3] * (np.abs(cell) < 1)
            of_gates = np.concatenate(
                (of_cell * gates[H3:], of_cell * before, of_hidden * bent, of_cell * gates[:H1])
            )
            # A little slope beyond the clips lets a saturated gate come back.
            of_gates[:H3] *= np.where((raw[:H3] > 0) & (raw[:H3] < 1), 1, 0.05)
            of_gates[H3:] *= np.where(np.abs(raw[H3:]) < 1, 1, 0.05)
            of_h += of_gates @ was.T
            np.add.at(of_x.T, codes[t], of_gates.T)
            of_cell, of_hidden = of_cell * gates[H1:H2], recur.T @ of_gates
        out |= {f"x{way}": of_x, f"h{way}": of_h, f"o{way}": of_o}
    return out


def train(codes: np.ndarray, tags: np.ndarray, steps: int, batch: int, seed: int) -> dict[str, np.ndarray]:
    """Weights fitted by Adam to labelled windows; ``codes`` and ``tags``: (window, position)."""
    random = np.random.default_rng(seed)
    weights = fresh(seed)
    first = {name: np.zeros_like(w) for name, w in weights.items()}
    second = {name: np.zeros_like(w) for name, w in weights.items()}
    for t in range(1, steps + 1):
        some = random.integers(0, len(codes), batch)
        found = gradients(weights, np.ascontiguousarray(codes[some].T), np.ascontiguousarray(tags[some].T))
        norm = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
        rate = 0.02 * min(1, t / 20) * (1 - t / (steps + 1)) ** 0.5
        for name, g in found.items():
            g = g * min(1, 5 / (norm + 1e-6))
            first[name] = 0.9 * first[name] + 0.1 * g
            second[name] = 0.99 * second[name] + 0.01 * g * g
            move = first[name] / (1 - 0.9**t) / (np.sqrt(second[name] / (1 - 0.99**t)) + 1e-6)
            weights[name] = (weights[name] - rate * move).astype(np.float32)
    return weights
