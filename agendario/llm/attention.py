"""A small causal self-attention model over subword ids, in numpy: training and scoring.

One head, one layer, windows of ``CONTEXT`` context and ``SCORED`` scored places; consecutive windows overlap by
the context, so each token is scored once with at least ``CONTEXT`` tokens before it (or all there are). Keys
before a text and after the query are masked.

The next id is predicted as three digits of base 37 (id = (a * 37 + b) * 37 + c), each by a softmax of 37:
p(a) p(b | a) p(c | a, b) is a proper distribution over ids. The biases of the three are the corpus-wide
subword counts, so an untrained model is the unigram model of the whole corpus.
"""

from __future__ import annotations

import numpy as np

CONTEXT = 32
SCORED = 32
WINDOW = CONTEXT + SCORED
BASE = 37
DIM = 16
INNER = 32
BATCH = 64

_SEEN = np.tril(np.ones((SCORED, WINDOW), bool), CONTEXT)
_OFFSET = np.clip(CONTEXT + np.arange(SCORED)[:, None] - np.arange(WINDOW)[None, :], 0, WINDOW - 1)


def initial(vocabulary: int, seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    d = DIM

    def normal(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)

    return {
        "E": normal(vocabulary, d, scale=0.3),
        "Wq": normal(d, d, scale=0.25), "Wk": normal(d, d, scale=0.25), "Wv": normal(d, d, scale=0.25),
        "R": (-0.05 * np.arange(WINDOW)).astype(np.float32),
        "W1": normal(d, INNER, scale=0.3), "c1": np.zeros(INNER, np.float32), "W2": normal(INNER, d, scale=0.2),
        "U1": normal(d, BASE, scale=0.1), "U2": normal(d, BASE, scale=0.1), "U3": normal(d, BASE, scale=0.1),
        "G2": 1 + normal(BASE, d, scale=0.3), "G3": 1 + normal(BASE * BASE, d, scale=0.3),
    }


def biases(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log chances of the digits from the counts of all ids (each plus one tenth)."""
    full = np.zeros(BASE**3)
    full[: len(counts)] = counts + 0.1
    cube = full.reshape(BASE, BASE, BASE)
    ab, a = cube.sum(2), cube.sum((1, 2))
    with np.errstate(divide="ignore"):
        out = np.log(a / a.sum()), np.log(ab / np.maximum(a, 1e-9)[:, None]), np.log(cube / np.maximum(ab, 1e-9)[:, :, None]).reshape(-1, BASE)
    return tuple(np.maximum(x, -60).astype(np.float32) for x in out)


def windows(ids: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, first valid key, targets (-1 beyond the end) and owner of all windows of some texts.

    The input before each target; ``start`` stands before a text's first token.
    """
    owner, at = places(lengths)
    return *windows_at(ids, lengths, np.cumsum(lengths) - lengths, owner, at, start), owner


def places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and first scored place of all windows of some texts."""
    per = -(-lengths // SCORED)
    owner = np.repeat(np.arange(len(lengths)), per)
    return owner, (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)) * SCORED


def windows_at(ids: np.ndarray, lengths: np.ndarray, begin: np.ndarray, owner: np.ndarray, at: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, first valid key and targets of the windows of these owners and places; ``begin`` is where each text begins."""
    place = at[:, None] + np.arange(-CONTEXT, SCORED)[None, :]
    place_ok = (place >= 0) & (place < lengths[owner][:, None])
    source = np.where(place_ok & (place > 0), begin[owner][:, None] + place - 1, 0)
    inputs = np.where(place > 0, ids[source].astype(np.int64), start)
    target_ok = place_ok[:, CONTEXT:]
    targets = np.where(target_ok, ids[np.where(target_ok, begin[owner][:, None] + place[:, CONTEXT:], 0)].astype(np.int64), -1)
    return inputs, np.maximum(CONTEXT - at, 0), targets


def _softmax_loss(logits: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log chance of each digit, and the exponentials with their sums left in ``logits``."""
    chosen = logits.ravel().take(np.arange(0, logits.size, logits.shape[1]) + digit)
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], logits.dtype)
    return chosen - np.log(total), total


class Model:
    def __init__(self, weights: dict[str, np.ndarray], counts: np.ndarray):
        self.w = weights
        self.b1, self.b2, self.b3 = biases(counts)
        self.tables()

    def tables(self) -> None:
        """Keys, values and queries depend on the id alone: they are looked up."""
        w = self.w
        self.keys_values = w["E"] @ np.concatenate([w["Wk"], w["Wv"]], axis=1)
        self.queries = w["E"] @ w["Wq"] / np.float32(np.sqrt(DIM))

    def hidden(self, inputs: np.ndarray, first: np.ndarray) -> tuple:
        """Attention and inner layer of the scored places of each window."""
        w = self.w
        scored = inputs[:, CONTEXT:]
        q, both = self.queries.take(scored, axis=0), self.keys_values.take(inputs, axis=0)
        k, v = both[:, :, :DIM], both[:, :, DIM:]
        scores = q @ k.transpose(0, 2, 1)
        np.minimum(scores, 40, out=scores)
        scores += np.where(_SEEN, w["R"][_OFFSET], np.float32(-1000))
        np.exp(scores, out=scores)
        late = np.flatnonzero(first)
        if len(late):
            scores[late] *= np.arange(WINDOW)[None, None, :] >= first[late][:, None, None]
        total = scores.sum(2, keepdims=True)
        y = (w["E"].take(scored, axis=0) + scores @ v / total).reshape(-1, DIM)
        inner = y @ w["W1"]
        inner += w["c1"]
        np.maximum(inner, 0, out=inner)
        return q, k, v, (scores, total), y, inner, y + inner @ w["W2"]

    def log_chances(self, inputs: np.ndarray, first: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log chance of each target (0 where there is none)."""
        z = self.hidden(inputs, first)[-1]
        flat = targets.ravel()
        ok = np.flatnonzero(flat >= 0)
        z, t = z if len(ok) == len(flat) else z.take(ok, axis=0), flat[ok]
        ab, c = np.divmod(t, BASE)
        a, b = np.divmod(ab, BASE)
        w = self.w
        out = np.zeros(len(flat), np.float32)

        def digit(inputs: np.ndarray, heads: str, bias: np.ndarray, which: np.ndarray) -> np.ndarray:
            logits = inputs @ w[heads]
            logits += bias
            return _softmax_loss(logits, which)[0]

        total = digit(z, "U1", self.b1, a)
        total += digit(w["G2"].take(a, axis=0) * z, "U2", self.b2.take(a, axis=0), b)
        total += digit(w["G3"].take(ab, axis=0) * z, "U3", self.b3.take(ab, axis=0), c)
        out[ok] = total
        return out.reshape(targets.shape)

    def score(self, ids: np.ndarray, lengths: np.ndarray, start: int, most: int = 256) -> np.ndarray:
        """log10 chance of each text, ``most`` windows at a time."""
        inputs, first, targets, owner = windows(ids, lengths, start)
        out = np.zeros(len(lengths))
        for at in range(0, len(owner), most):
            part = slice(at, at + most)
            each = self.log_chances(inputs[part], first[part], targets[part]).sum(1, dtype=np.float64)
            np.add.at(out, owner[part], each)
        return out / np.log(10)

    def gradient(self, inputs: np.ndarray, first: np.ndarray, targets: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss of the targets, and its gradient by every weight."""
        loss, g = self.met_gradient(inputs, first, targets)
        for k in ("E", "G2", "G3"):
            rows, values = g[k]
            g[k] = np.zeros(self.w[k].shape, values.dtype)
            g[k][rows] = values
        return loss, g

    def met_gradient(self, inputs: np.ndarray, first: np.ndarray, targets: np.ndarray) -> tuple[float, dict]:
        """The same; ``E``, ``G2`` and ``G3`` as the rows met and their gradients (the others are 0).

        Gradients by keys, values and queries are summed by id before they go through the weights.
        """
        w = self.w
        q, k, v, (p, total), y, inner, z = self.hidden(inputs, first)
        p /= total
        flat = targets.ravel()
        ok = np.flatnonzero(flat >= 0)
        part = len(ok) < len(flat)
        t = flat[ok] if part else flat
        z_ok = z.take(ok, axis=0) if part else z
        n = max(len(ok), 1)
        ab, c = np.divmod(t, BASE)
        a, b = np.divmod(ab, BASE)
        g: dict = {}
        dz, loss = None, 0.0
        for name, row, digit in (("1", None, a), ("2", a, b), ("3", ab, c)):
            gate = None if row is None else w["G" + name].take(row, axis=0)
            gated = z_ok if row is None else z_ok * gate
            logits = gated @ w["U" + name]
            logits += self.b1 if row is None else (self.b2 if name == "2" else self.b3).take(row, axis=0)
            log_chance, sums = _softmax_loss(logits, digit)
            loss -= float(log_chance.sum()) / n
            logits *= (1 / (n * sums))[:, None]
            logits.ravel()[np.arange(0, logits.size, BASE) + digit] -= 1 / n
            g["U" + name] = gated.T @ logits
            back = logits @ w["U" + name].T
            if row is None:
                dz = back
            else:
                g["G" + name] = _scattered(row, back * z_ok)
                back *= gate
                dz += back
        full = dz
        if part:
            full = np.zeros_like(z)
            full[ok] = dz
        d_inner = full @ w["W2"].T
        d_inner *= inner > 0
        g["W2"], g["W1"], g["c1"] = inner.T @ full, y.T @ d_inner, d_inner.sum(0)
        full += d_inner @ w["W1"].T
        dy = full.reshape(len(inputs), SCORED, DIM)
        ds = dy @ v.transpose(0, 2, 1)
        own = p * ds
        ds -= own.sum(2, keepdims=True)
        ds *= p
        g["R"] = np.bincount(_OFFSET.ravel(), ds.sum(0).ravel(), WINDOW).astype(ds.dtype)
        both = np.concatenate([ds.transpose(0, 2, 1) @ q, p.transpose(0, 2, 1) @ dy], axis=2)
        ids, by_key = _scattered(inputs.ravel(), both.reshape(-1, 2 * DIM))
        scored, by_query = _scattered(inputs[:, CONTEXT:].ravel(), np.concatenate([ds @ k, dy], axis=2).reshape(-1, 2 * DIM))
        e, wkv = w["E"].take(ids, axis=0), np.concatenate([w["Wk"], w["Wv"]], axis=1)
        by_weight = e.T @ by_key
        g["Wk"], g["Wv"] = by_weight[:, :DIM], by_weight[:, DIM:]
        dq = by_query[:, :DIM] / np.float32(np.sqrt(DIM))
        g["Wq"] = w["E"].take(scored, axis=0).T @ dq
        de = by_key @ wkv.T
        de[np.searchsorted(ids, scored)] += dq @ w["Wq"].T + by_query[:, DIM:]
        g["E"] = ids, de
        return loss, g

    def train(self, ids: np.ndarray, lengths: np.ndarray, start: int, rate: float, seed: int = 1, epochs: int = 1) -> int:
        """Adam over all windows of some texts in random order; the number of steps.

        Windows are cut out when their step comes, so that memory is little more than the ids.
        """
        if not len(lengths):
            return 0
        owner, at = places(lengths)
        begin = np.cumsum(lengths) - lengths
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(x) for k, x in self.w.items()}
        square = {k: np.zeros_like(x) for k, x in self.w.items()}
        steps = -(-epochs * len(owner) // BATCH)
        order = np.concatenate([rng.permutation(len(owner)) for _ in range(epochs)])
        seen = np.zeros(len(self.w["E"]), bool)

        def cut(step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            some = order[(step - 1) * BATCH : step * BATCH]
            return windows_at(ids, lengths, begin, owner[some], at[some], start)

        batch = cut(1)
        for step in range(1, steps + 1):
            _, g = self.met_gradient(*batch)
            now = np.float32(rate * min(1.0, step / 20) * (1 - 0.9 * step / steps) / (1 - 0.9**step))
            late = np.float32(1 / (1 - 0.98**step))
            for k, x in g.items():
                rows, x = x if isinstance(x, tuple) else (slice(None), x)
                m, s = mean[k][rows], square[k][rows]
                m *= np.float32(0.9)
                m += np.float32(0.1) * x
                s *= np.float32(0.98)
                s += np.float32(0.02) * x * x
                mean[k][rows], square[k][rows] = m, s
                self.w[k][rows] -= now * m / (np.sqrt(s * late) + np.float32(1e-6))
            batch = cut(step + 1)
            seen[:] = False
            seen[batch[0]] = True
            self.tables_of(np.flatnonzero(seen))
        self.tables()
        return steps

    def tables_of(self, ids: np.ndarray) -> None:
        """The looked-up rows that the next step needs."""
        w, e = self.w, self.w["E"].take(ids, axis=0)
        self.keys_values[ids] = e @ np.concatenate([w["Wk"], w["Wv"]], axis=1)
        self.queries[ids] = e @ w["Wq"] / np.float32(np.sqrt(DIM))


def _scattered(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct row numbers (below 65,536), ascending, and the sums of ``values`` by them."""
    order = np.argsort(rows.astype(np.uint16), kind="stable")
    own = rows.take(order)
    cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
    return own[cuts], np.add.reduceat(values.take(order, axis=0), cuts, axis=0) if len(cuts) else np.zeros((0, values.shape[1]), values.dtype)
