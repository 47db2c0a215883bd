"""A small causal self-attention model in numpy.

One attention layer and a tanh layer over subword ids predict the group of the
next id by a softmax; within the group, corpus counts of the ids after the id before it
share out the probability.  Frequent ids are groups of their own; the others
are grouped by the ids that come before and after them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

#: Ids with an embedding of their own; groups, and those of a single id.
EMBEDDED, GROUPS, SINGLE = 4096, 96, 64
WIDTH = 32
#: Positions of a window, and how many of them a window scores (all, for the first of a text).
WINDOW, STRIDE = 32, 24
#: Steps of a fit at least.
STEPS = 1_000

MASKED = np.float32(-1e9)
#: Windows whose gradients are worked out at once, and numbers that a step changes at once.
PART, PIECE = 32, 1 << 14

#: Ids before that have counts of their own; the others and word starts share one each.
CONTEXTS = 768
#: Weight of an id's share over all contexts, in counts.
PRIOR = 20.0


@dataclass
class Vocabulary:
    """Of every tokenizer id, and the end: its embedding row, its group, its share of the group."""

    row: np.ndarray
    group: np.ndarray
    share: np.ndarray
    log_given: np.ndarray | None = None

    @property
    def start(self) -> int:
        return int(self.row.max()) + 1

    def contexts(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The context of every id of a sequence; `first` marks the first ids of words."""
        before = np.minimum(self.row[np.concatenate([ids[:1], ids[:-1]])], CONTEXTS - 2)
        return np.where(first, CONTEXTS - 1, before)

    def set_pairs(self, pairs: np.ndarray) -> None:
        """`pairs` counts (context, row) over all training texts."""
        rows = pairs.shape[1]
        group, share = np.full(rows, GROUPS - 1), np.zeros(rows)
        group[self.row], share[self.row] = self.group, self.share
        member = np.zeros((rows, GROUPS), np.float32)
        member[np.arange(rows), group] = 1
        whole = (pairs @ member)[:, group]
        self.log_given = np.log10((pairs + PRIOR * share + 1e-9) / (whole + PRIOR)).astype(np.float32)

    def log_share(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 of every id's share of its group after the id before it."""
        row = self.row[ids]
        given = self.log_given[self.contexts(ids, first), row]
        return np.where(row < EMBEDDED, given, np.log10(self.share[ids]))


def vocabulary(counts: np.ndarray, texts: list[np.ndarray], seed: int = 5) -> Vocabulary:
    """`counts` are of all ids, the end last, over all training texts; `texts` are sample ids."""
    n = len(counts)
    order = np.lexsort((np.arange(n), -counts))
    row = np.full(n, EMBEDDED, np.int64)
    row[order[:EMBEDDED]] = np.arange(min(EMBEDDED, n))
    end = n - 1
    if row[end] == EMBEDDED:
        row[end] = EMBEDDED - 1
        row[order[EMBEDDED - 1]] = EMBEDDED
    group = np.full(n, GROUPS - 1, np.int64)
    single = order[:SINGLE]
    group[single] = np.arange(len(single))
    # Profiles: how often each of the most frequent ids is next to an id.
    profile = np.zeros((EMBEDDED + 1, 2 * SINGLE), np.float32)
    for ids in texts:
        left, right = ids[:-1], ids[1:]
        common = group[left] < SINGLE
        np.add.at(profile, (row[right[common]], group[left[common]]), 1)
        common = group[right] < SINGLE
        np.add.at(profile, (row[left[common]], SINGLE + group[right[common]]), 1)
    profile = np.sqrt(profile / np.maximum(profile.sum(axis=1, keepdims=True), 1))
    others = order[SINGLE:EMBEDDED]
    if len(others):
        points, k = profile[row[others]], GROUPS - 1 - SINGLE
        rng = np.random.default_rng(seed)
        centre = points[rng.choice(len(points), k, replace=len(points) < k)]
        for _ in range(12):
            nearest = (points @ centre.T - (centre**2).sum(axis=1) / 2).argmax(axis=1)
            size = np.bincount(nearest, minlength=k)[:, None]
            total = np.zeros_like(centre)
            np.add.at(total, nearest, points)
            centre = np.where(size > 0, total / np.maximum(size, 1), centre)
        group[others] = SINGLE + nearest
    smooth = counts + 0.5
    share = smooth / np.bincount(group, smooth, GROUPS)[group]
    return Vocabulary(row, group, share)


def _exps(scores: Callable[[], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray | np.float32]:
    """e^(score - top), its sums along the last axis, and top: 0 unless a sum would overflow or vanish."""
    x = scores()
    ones = np.ones(x.shape[-1], x.dtype)
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(x, out=x)
        total = x @ ones
    if total.min(initial=1) > 1e-30 and total.max(initial=1) < 1e30:
        return x, total, np.float32(0)
    x = scores()
    top = x.max(axis=-1)
    x -= top[..., None]
    np.exp(x, out=x)
    return x, x @ ones, top


class Attention:
    """Parameters, training and scoring."""

    def __init__(self, words: Vocabulary, seed: int = 7):
        rng = np.random.default_rng(seed)
        normal = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        d = WIDTH
        self.words = words
        self.p = {
            "E": normal(words.start + 1, d, by=0.3),
            "Q": normal(d, d, by=d**-0.5), "K": normal(d, d, by=d**-0.5), "V": normal(d, d, by=0.5 * d**-0.5),
            "R": np.zeros(WINDOW, np.float32),
            "U": normal(d, GROUPS, by=d**-0.5),
            "u": np.zeros(GROUPS, np.float32),
        }
        self.tables: tuple | None = None

    # A bias by distance; the future is masked.
    def _bias(self) -> np.ndarray:
        apart = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
        return np.where(apart >= 0, self.p["R"][np.maximum(apart, 0)], MASKED).astype(np.float32)

    def _windows(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Inputs (embedding rows) and targets (ids, -1 for padding) of whole windows of the texts."""
        inputs, targets = [], []
        for ids in texts:
            n = -(-len(ids) // WINDOW) * WINDOW
            x, y = np.full(n, self.words.start), np.full(n, -1)
            x[1 : len(ids)], y[: len(ids)] = self.words.row[ids[:-1]], ids
            inputs.append(x)
            targets.append(y)
        return np.concatenate(inputs).reshape(-1, WINDOW), np.concatenate(targets).reshape(-1, WINDOW)

    def add_layer(self, seed: int = 13) -> None:
        """The tanh layer behind the attention; a model that is not fitted has none."""
        rng = np.random.default_rng(seed)
        self.p["A"] = (rng.standard_normal((WIDTH, WIDTH)) * WIDTH**-0.5).astype(np.float32)
        self.p["a"] = np.zeros(WIDTH, np.float32)

    def fit(self, texts: list[np.ndarray], steps: int | None = None, batch: int = 96, rate: float = 4e-3, seed: int = 11) -> None:
        """By default one step for each text, STEPS at least."""
        if not texts:
            return
        steps = steps or max(STEPS, len(texts))
        self.add_layer()
        inputs, targets = self._windows(texts)
        rng = np.random.default_rng(seed)
        moments = self._moments()
        for step in range(1, steps + 1):
            some = rng.integers(0, len(inputs), batch)
            self._step(inputs[some], targets[some], moments, step, rate * min(1, step / 50) * (1 - step / (steps + 1)))

    def _moments(self) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        return {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}

    def _step(self, x: np.ndarray, y: np.ndarray, moments: tuple, step: int, rate: float) -> None:
        """One step of Adam, in place and in pieces that stay in the cache."""
        rate, unbias = rate / (1 - 0.9**step), np.sqrt(1 - 0.99**step)
        grads, rows, by_row = self._sums(x, y)
        for k, p in self.p.items():
            first, second = moments[0][k], moments[1][k]
            first *= 0.9
            second *= 0.99
            if k == "E":
                first[rows] += 0.1 * by_row
                second[rows] += 0.01 * by_row * by_row
            else:
                first += 0.1 * grads[k]
                second += 0.01 * grads[k] * grads[k]
            first, second, p = first.reshape(-1), second.reshape(-1), p.reshape(-1)
            for at in range(0, p.size, PIECE):
                change = np.sqrt(second[at : at + PIECE])
                change += float(1e-8 * unbias)
                np.divide(first[at : at + PIECE], change, out=change)
                change *= float(rate * unbias)
                p[at : at + PIECE] -= change
        self.tables = None

    def fit_once(self, texts: Iterator[list[np.ndarray]], rate: float, batch: int = 96, seed: int = 11) -> int:
        """Steps over every window of the texts, each in one step; the number of windows."""
        if "A" not in self.p:
            self.add_layer()
        rng = np.random.default_rng(seed)
        moments, step, windows = self._moments(), 0, 0
        for some in texts:
            inputs, targets = self._windows(some)
            order = rng.permutation(len(inputs))
            windows += len(inputs)
            for at in range(0, len(inputs), batch):
                step += 1
                here = order[at : at + batch]
                # A batch that is not full counts by its size.
                now = rate * min(1, step / 50) * len(here) / batch
                self._step(inputs[here], targets[here], moments, step, now)
        return windows

    def _product(self) -> np.ndarray:
        """M = Q K^T, scaled; the score of two places is e M e^T."""
        return self.p["Q"] @ self.p["K"].T * np.float32(WIDTH**-0.5)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean loss over the known targets, by every parameter."""
        g, rows, by_row = self._sums(x, y)
        g["E"] = np.zeros_like(self.p["E"])
        g["E"][rows] = by_row
        return g

    def _sums(self, x: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Gradients by all parameters but E, the rows of E that the inputs use, and the gradients by these rows.

        The batch is cut into parts that stay in the cache.
        """
        p, weight = self.p, 1 / max(1, np.count_nonzero(y >= 0))
        m, bias = self._product(), self._bias()
        g: dict[str, np.ndarray] = {}
        by_input = []
        for at in range(0, len(x), PART):
            part, by_x = self._part_gradients(x[at : at + PART], y[at : at + PART], weight, m, bias)
            by_input.append(by_x)
            for k, v in part.items():
                g[k] = g[k] + v if k in g else v
        by_m, by_pair, scale = g.pop("M"), g.pop("pair"), np.float32(WIDTH**-0.5)
        g["Q"], g["K"] = by_m @ p["K"] * scale, by_m.T @ p["Q"] * scale
        apart = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
        g["R"] = np.bincount(np.maximum(apart, 0).ravel(), np.where(apart >= 0, by_pair, 0).ravel(), WINDOW).astype(np.float32)
        # Embedding rows are few enough for the fast sort of short integers.
        x = x.reshape(-1)
        order = np.argsort(x.astype(np.uint16), kind="stable")
        x = x[order]
        starts = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        return g, x[starts], np.add.reduceat(np.concatenate(by_input).take(order, axis=0), starts, axis=0)

    def _part_gradients(
        self, x: np.ndarray, y: np.ndarray, weight: float, m: np.ndarray, bias: np.ndarray
    ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients by all parameters but E, by M and the scores of each pair of places; and by every input."""
        p, d, ones = self.p, WIDTH, np.ones(x.size, self.p["E"].dtype)
        e = p["E"].take(x, axis=0)
        flat = e.reshape(-1, d)
        em, ev = (flat @ m).reshape(e.shape), (flat @ p["V"]).reshape(e.shape)

        def scores() -> np.ndarray:
            s = em @ e.transpose(0, 2, 1)
            s += bias
            return s

        s, total, _ = _exps(scores)
        total = 1 / total[:, :, None]
        mix = s @ ev
        mix *= total
        h = (e + mix).reshape(-1, d)
        z = h
        if "A" in p:
            t = h @ p["A"]
            t += p["a"]
            np.tanh(t, out=t)
            z = h + t

        def logits() -> np.ndarray:
            x = z @ p["U"]
            x += p["u"]
            return x

        out, whole, _ = _exps(logits)
        y = y.reshape(-1)
        known = np.flatnonzero(y >= 0)
        part = np.zeros(len(y), out.dtype)
        part[known] = weight / whole[known]
        out *= part[:, None]
        out.reshape(-1)[known * GROUPS + self.words.group[y[known]]] -= weight
        g = {"U": z.T @ out, "u": ones @ out}
        dh = out @ p["U"].T
        if "A" in p:
            t *= t
            np.subtract(1, t, out=t)
            t *= dh
            g["A"], g["a"] = h.T @ t, ones @ t
            dh += t @ p["A"].T
        # The sums of the attention are left in the factors of width d.
        dmix = dh.reshape(e.shape) * total
        ds = dmix @ ev.transpose(0, 2, 1)
        ds -= np.einsum("bid,bid->bi", dmix, mix)[:, :, None]
        ds *= s
        g["pair"] = (ones[: len(ds)] @ ds.reshape(len(ds), -1)).reshape(WINDOW, WINDOW)
        dem, dev = (ds @ e).reshape(-1, d), (s.transpose(0, 2, 1) @ dmix).reshape(-1, d)
        g["M"], g["V"] = flat.T @ dem, flat.T @ dev
        dh += (ds.transpose(0, 2, 1) @ em).reshape(-1, d)
        dh += dem @ m.T
        dh += dev @ p["V"].T
        return g, dh

    def _batches(self, texts: list[np.ndarray], size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Windows of STRIDE scored positions behind up to WINDOW - STRIDE of context, `size` at a time; which are a text's first."""
        lead, start = WINDOW - STRIDE, self.words.start
        lengths = np.array([len(t) for t in texts], np.int64)
        n = -(-lengths // STRIDE)
        if not n.sum():
            return
        ids = np.concatenate(texts)
        # The place of every id among the padded texts; inputs have the context of the first window before them.
        of = np.repeat(np.arange(len(texts)), lengths)
        at = np.arange(len(ids)) + ((np.cumsum(n) - n) * STRIDE - (np.cumsum(lengths) - lengths))[of]
        y = np.full(n.sum() * STRIDE, -1)
        y[at] = ids
        x = np.full(len(y) + lead * len(texts), start)
        before = self.words.row.take(ids[:-1])
        inside = of[1:] == of[:-1]
        x[(at + lead * (of + 1))[1:][inside]] = before[inside]
        y = y.reshape(-1, STRIDE)
        which = np.repeat(np.arange(len(texts)), n)
        begin = np.arange(len(y)) * STRIDE + lead * which
        first = np.concatenate([[True], which[1:] != which[:-1]])
        windows = np.lib.stride_tricks.sliding_window_view(x, WINDOW)
        for i in range(0, len(y), size):
            yield windows[begin[i : i + size]], y[i : i + size], np.flatnonzero(first[i : i + size])

    def score(self, texts: list[np.ndarray], size: int = 128) -> np.ndarray:
        """log10 probability of the group of every id of the texts, one after another.

        Each id is scored once, with the ids before it in its window.
        """
        p, d, lead = self.p, WIDTH, WINDOW - STRIDE
        if self.tables is None:
            self.tables = (p["E"] @ self._product(), p["E"] @ p["V"], self._bias()[lead:])
        by_m, by_v, bias = self.tables
        out = []
        for x, y, first in self._batches(texts, size):
            em, e, ev = by_m.take(x[:, lead:], axis=0), p["E"].take(x, axis=0), by_v.take(x, axis=0)

            def scores() -> np.ndarray:
                s = em @ e.transpose(0, 2, 1)
                s += bias
                # Nothing is before a text; what is behind it is masked as the future.
                s[first, :, :lead] = MASKED
                return s

            weight, total, _ = _exps(scores)
            mix = weight @ ev
            mix *= (1 / total)[:, :, None]
            mix += e[:, lead:]
            h = mix.reshape(-1, d)
            if "A" in p:
                t = h @ p["A"]
                t += p["a"]
                h += np.tanh(t, out=t)
            y = y.reshape(-1)
            real = np.flatnonzero(y >= 0)
            wanted = real * GROUPS + self.words.group.take(y.take(real))
            picked = None

            def logits() -> np.ndarray:
                nonlocal picked
                x = h @ p["U"]
                x += p["u"]
                picked = x.reshape(-1).take(wanted)
                return x

            _, whole, top = _exps(logits)
            norm = (np.log(whole) + top).take(real)
            out.append((picked - norm) / np.log(10))
        return np.concatenate(out) if out else np.zeros(0)
