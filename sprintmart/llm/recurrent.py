"""A small gated recurrent network over words, in numpy, with a class-factored output.

Inputs are ids: 0 to ``words``-1 are frequent words, then come classes of rarer words, then the start of a
text. The output first chooses among classes (groups of ``GROUP`` frequent words, and the classes of
rarer words), then, for a frequent word, among the words of its group. Training cuts
back-propagation after ``STEPS`` tokens but carries the state on; scoring carries it to the text's end.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
GROUP = 32
STEPS = 16

#: Tokens whose output layer is worked out at once, so that it stays in a processor's own cache.
BLOCK = 2048

F4 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters by name, all float32."""

    def __init__(self, words: int, tails: int, parameters: dict[str, np.ndarray] | None = None, seed: int = 1) -> None:
        self.words, self.tails = words, tails
        self.groups = -(-words // GROUP)
        self.start = words + tails
        if parameters is None:
            rng = np.random.default_rng(seed)
            draw = lambda scale, *shape: rng.normal(0, scale, shape).astype(F4)
            parameters = {
                "x": draw(0.1, words + tails + 1, 3 * HIDDEN),
                "u": draw(HIDDEN**-0.5, HIDDEN, 3 * HIDDEN),
                "b": np.concatenate((np.full(HIDDEN, 1, F4), np.zeros(2 * HIDDEN, F4))),
                "c": draw(0.1, HIDDEN, self.groups + tails),
                "cb": np.zeros(self.groups + tails, F4),
                "w": draw(0.1, self.groups, HIDDEN, GROUP),
                "wb": np.zeros((self.groups, GROUP), F4),
            }
        self.p = parameters

    def set_frequencies(self, counts: np.ndarray) -> None:
        """Start the output at the frequencies of words (then tail classes)."""
        counts = np.asarray(counts, float) + 0.5
        head = np.zeros(self.groups * GROUP)
        head[: self.words] = counts[: self.words]
        head = head.reshape(self.groups, GROUP)
        self.p["wb"] = np.log(head + 1e-9).astype(F4)
        self.p["cb"] = np.log(np.concatenate((head.sum(1), counts[self.words :]))).astype(F4)

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.words, ids // GROUP, ids - self.words + self.groups)

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """New state from the input's row of gates and the old state."""
        hu = h @ self.p["u"]
        zr = sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        inner = hu[:, 2 * HIDDEN :]
        n = np.tanh(x[:, 2 * HIDDEN :] + r * inner)
        return n + z * (h - n), z, r, n, inner

    def log_likelihoods(self, h: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log probability of each id after its state; a tail class stands for all its words."""
        p = self.p
        kinds = self.classes(ids)
        # Tokens lie along the last axis, over which sums and exponentials run fastest.
        states = np.ascontiguousarray(h.T)
        out = np.empty(len(ids), F4)
        for a in range(0, len(ids), BLOCK):
            part = slice(a, a + BLOCK)
            logits = p["c"].T @ states[:, part] + p["cb"][:, None]
            # States are bounded by one, so the logits need no shift to stay finite.
            out[part] = logits[kinds[part], np.arange(logits.shape[1])]
            np.exp(logits, out=logits)
            out[part] -= np.log(logits.sum(0))
        order = np.argsort(kinds, kind="stable")
        cuts = np.searchsorted(kinds[order], np.arange(self.groups + 1))
        states = states[:, order]
        for g in range(self.groups):
            a, b = cuts[g], cuts[g + 1]
            if a < b:
                at = order[a:b]
                words = p["w"][g].T @ states[:, a:b] + p["wb"][g][:, None]
                out[at] += words[ids[at] - g * GROUP, np.arange(b - a)] - np.log(np.exp(words).sum(0))
        return out

    def score(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Natural log likelihood of each text of a flat array of ids, the state carried through the whole text."""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        start, length = offsets[:-1][order], lengths[order]
        total = np.zeros(len(order))
        gates = self.p["x"] + self.p["b"]
        h = np.zeros((len(order), HIDDEN), F4)
        before = np.full(len(order), self.start)
        t, longest = 0, int(length[0]) if len(length) else 0
        while t < longest:
            states, targets, lanes = [], [], []
            size = 0
            # A window: as many steps as make a block of work, fewer texts at each once the short ones have ended.
            while t < longest and size < 16_384 and len(states) < 256:
                n = int(np.searchsorted(-length, -t, "left"))
                h, before = h[:n], before[:n]
                h = self.step(gates[before], h)[0]
                before = ids[start[:n] + t]
                states.append(h)
                targets.append(before)
                lanes.append(np.arange(n))
                size += n
                t += 1
            found = self.log_likelihoods(np.concatenate(states), np.concatenate(targets))
            total += np.bincount(np.concatenate(lanes), weights=found, minlength=len(order))
        out = np.empty(len(order))
        out[order] = total
        return out

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray, float]:
        """Gradients of the mean loss over a window (steps, lanes), the state after it, and the loss. A start
        among the inputs clears its lane's state."""
        p = self.p
        steps, lanes = inputs.shape
        gates = p["x"] + p["b"]
        kept, states = [], []
        for t in range(steps):
            clear = inputs[t] == self.start
            h = np.where(clear[:, None], F4(0), h)
            old = h
            h, z, r, n, inner = self.step(gates[inputs[t]], h)
            kept.append((old, z, r, n, inner, clear))
            states.append(h)
        flat, ids = np.ascontiguousarray(np.concatenate(states).T), targets.ravel()
        scale = F4(1 / len(ids))
        kinds = self.classes(ids)
        loss = 0.0
        g = {k: np.zeros_like(p[k]) for k in ("c", "cb", "w", "wb")}
        dflat = np.empty_like(flat)
        for a in range(0, len(ids), BLOCK):
            part = flat[:, a : a + BLOCK]
            prob = p["c"].T @ part
            prob += p["cb"][:, None]
            np.exp(prob, out=prob)
            prob *= scale / prob.sum(0)
            own = kinds[a : a + BLOCK], np.arange(part.shape[1])
            loss -= np.log(prob[own] / scale + 1e-12).sum()
            prob[own] -= scale
            g["c"] += part @ prob.T
            g["cb"] += prob.sum(1)
            dflat[:, a : a + BLOCK] = p["c"] @ prob
        order = np.argsort(kinds, kind="stable")
        cuts = np.searchsorted(kinds[order], np.arange(self.groups + 1))
        sorted_states = flat[:, order[: cuts[-1]]]
        for k in range(self.groups):
            a, b = cuts[k], cuts[k + 1]
            if a == b:
                continue
            at, part = order[a:b], sorted_states[:, a:b]
            q = np.exp(p["w"][k].T @ part + p["wb"][k][:, None])
            q /= q.sum(0)
            own = ids[at] - k * GROUP, np.arange(b - a)
            loss -= np.log(q[own] + 1e-12).sum()
            q[own] -= 1
            q *= scale
            g["w"][k], g["wb"][k] = part @ q.T, q.sum(1)
            dflat[:, at] += p["w"][k] @ q
        dstates = np.ascontiguousarray(dflat.T)
        dstates = dstates.reshape(steps, lanes, HIDDEN)
        dgates = np.empty((steps, lanes, 3 * HIDDEN), F4)
        g["u"] = np.zeros_like(p["u"])
        dh = np.zeros((lanes, HIDDEN), F4)
        for t in reversed(range(steps)):
            old, z, r, n, inner, clear = kept[t]
            dh = dh + dstates[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (old - n) * z * (1 - z)
            dr = dn * inner * r * (1 - r)
            dgates[t] = np.concatenate((dz, dr, dn), 1)
            dhu = np.concatenate((dz, dr, dn * r), 1)
            g["u"] += old.T @ dhu
            dh = dh * z + dhu @ p["u"].T
            dh[clear] = 0
        flat_gates, flat_inputs = dgates.reshape(-1, 3 * HIDDEN), inputs.ravel()
        g["b"] = flat_gates.sum(0)
        g["x"] = np.zeros_like(p["x"])
        order = np.argsort(flat_inputs, kind="stable")
        which, first = np.unique(flat_inputs[order], return_index=True)
        g["x"][which] = np.add.reduceat(flat_gates[order], first)
        return g, h, float(loss)


class Adam:
    def __init__(self, network: Network, rate: float) -> None:
        self.network, self.rate, self.t = network, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in network.p.items()}

    def update(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        cut = min(1.0, 1.0 / (norm + 1e-9))
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, x in g.items():
            x = x * F4(cut)
            self.m[k] += F4(0.1) * (x - self.m[k])
            self.v[k] += F4(0.001) * (x * x - self.v[k])
            self.network.p[k] -= F4(rate) * self.m[k] / (np.sqrt(self.v[k]) + F4(1e-6))


def train(network: Network, ids: np.ndarray, offsets: np.ndarray, rate: float, lanes: int = 64) -> float:
    """One pass over the texts, dealt out to lanes as streams; the mean loss of the pass. Each token is predicted
    from what stands before it in its text."""
    n_tokens = len(ids)
    if not n_tokens:
        return 0.0
    lanes = max(1, min(lanes, n_tokens // (4 * STEPS)))
    inputs = np.empty(n_tokens, np.int64)
    inputs[1:] = ids[:-1]
    inputs[offsets[:-1]] = network.start
    steps = n_tokens // lanes
    streams, goals = (a[: steps * lanes].reshape(lanes, steps).T for a in (inputs, ids.astype(np.int64)))
    adam = Adam(network, rate)
    h = np.zeros((lanes, HIDDEN), F4)
    loss = 0.0
    windows = range(0, steps, STEPS)
    for i, t in enumerate(windows):
        adam.rate = rate * (1 - 0.9 * i / len(windows))
        g, h, part = network.gradients(streams[t : t + STEPS], goals[t : t + STEPS], h)
        adam.update(g)
        loss += part
    return loss / (steps * lanes)
