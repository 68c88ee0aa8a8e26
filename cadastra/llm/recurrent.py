"""A bidirectional gated recurrent network over bytes in numpy, trained by backpropagation through time.

Each direction keeps a state h of `hidden` units. With x the byte's row of the input table and u = h U + b:
update z and reset r = gate(x + u), candidate c = soft(x + r u), h' = h + z (c - h), where soft(a) = a / (1 + |a|) and
gate(a) = (1 + soft(a)) / 2. Both states at a position give its label's logits.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Net:
    inputs: np.ndarray  # 2 x 256 x 3 hidden
    state: np.ndarray  # 2 x hidden x 3 hidden
    bias: np.ndarray  # 2 x 3 hidden
    out: np.ndarray  # 2 x hidden x labels
    out_bias: np.ndarray  # labels

    def parameters(self) -> list[np.ndarray]:
        return [self.inputs, self.state, self.bias, self.out, self.out_bias]

    @staticmethod
    def new(labels: int, hidden: int, seed: int = 5) -> Net:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 0.4, shape).astype(np.float32)
        return Net(draw(2, 256, 3 * hidden), draw(2, hidden, 3 * hidden), np.zeros((2, 3 * hidden), np.float32), draw(2, hidden, labels), np.zeros(labels, np.float32))

    def probabilities(self, x: np.ndarray, skip: int = 0) -> np.ndarray:
        """labels x time x batch: probabilities at every position of x (time x batch of bytes) but the first and last `skip`."""
        time, batch = x.shape
        hidden = self.state.shape[1]
        logits = np.empty((time - 2 * skip, batch, len(self.out_bias)), np.float32)
        # All arrays of a step are made once: at this size making them would cost more than the arithmetic.
        new = lambda *shape: np.empty(shape, np.float32)
        g, ug, tmp = new(2, batch, hidden), new(2, batch, hidden), new(2, batch, hidden)  # update and reset
        c, uc, one, score = new(batch, hidden), new(batch, hidden), new(batch, hidden), new(batch, len(self.out_bias))
        for way in (0, 1):
            h = np.zeros((batch, hidden), np.float32)
            tables = [np.ascontiguousarray(q) for q in np.split(self.inputs[way], 3, 1)]
            states = np.stack(np.split(self.state[way], 3, 1))
            bias, out = self.bias[way].reshape(3, 1, hidden), self.out[way]
            tables[0] += bias[0]
            tables[1] += bias[1]
            for t in range(time) if way == 0 else range(time - 1, -1, -1):
                at = x[t].astype(np.intp)
                np.take(tables[0], at, 0, out=g[0], mode="clip")
                np.take(tables[1], at, 0, out=g[1], mode="clip")
                np.take(tables[2], at, 0, out=c, mode="clip")
                np.matmul(h, states[:2], out=ug)
                np.matmul(h, states[2], out=uc)
                g += ug
                np.abs(g, tmp)
                tmp += 1
                g /= tmp
                g += 1
                g *= 0.5
                uc += bias[2]
                uc *= g[1]
                c += uc
                np.abs(c, one)
                one += 1
                c /= one
                c -= h
                c *= g[0]
                h += c
                if skip <= t < time - skip:
                    if way == 0:
                        np.matmul(h, out, out=logits[t - skip])
                    else:
                        np.matmul(h, out, out=score)
                        logits[t - skip] += score
        p = np.ascontiguousarray(logits.transpose(2, 0, 1))
        p += self.out_bias[:, None, None]
        p -= p.max(0)
        np.exp(p, out=p)
        p /= p.sum(0)
        return p

    def gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and gradients of the weighted cross-entropy over all positions, by backpropagation through time.

        x: time x batch of bytes; y: the batch's labels; weight: time x batch."""
        time, batch = x.shape
        hidden = self.state.shape[1]
        kept, logits = [], np.zeros((time, batch, len(self.out_bias)), np.float32) + self.out_bias
        for way in (0, 1):
            h, steps = np.zeros((batch, hidden), np.float32), {}
            for t in range(time) if way == 0 else range(time - 1, -1, -1):
                u = h @ self.state[way] + self.bias[way]
                a = self.inputs[way][x[t]]
                s = a[:, : 2 * hidden] + u[:, : 2 * hidden]
                g = 0.5 + 0.5 * s / (1 + np.abs(s))
                z, r = g[:, :hidden], g[:, hidden:]
                v = a[:, 2 * hidden :] + r * u[:, 2 * hidden :]
                c = v / (1 + np.abs(v))
                new = h + z * (c - h)
                steps[t] = (h, u, s, z, r, v, c, new)
                logits[t] += new @ self.out[way]
                h = new
            kept.append(steps)
        p = np.exp(logits - logits.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        total = max(weight.sum(), 1)
        loss = float(-(weight * np.log(p[:, np.arange(batch), y] + 1e-9)).sum() / total)
        d = p
        d[:, np.arange(batch), y] -= 1
        d *= (weight / total)[:, :, None]
        grads = [np.zeros_like(q) for q in self.parameters()]
        gi, gs, gb, go, gob = grads
        gob += d.sum((0, 1))
        for way in (0, 1):
            back = np.zeros((batch, hidden), np.float32)
            for t in range(time - 1, -1, -1) if way == 0 else range(time):
                h, u, s, z, r, v, c, new = kept[way][t]
                go[way] += new.T @ d[t]
                dh = back + d[t] @ self.out[way].T
                dz, dc = dh * (c - h), dh * z
                dv = dc / (1 + np.abs(v)) ** 2
                dr = dv * u[:, 2 * hidden :]
                ds = np.concatenate([dz, dr], 1) * 0.5 / (1 + np.abs(s)) ** 2
                du = np.concatenate([ds, dv * r], 1)
                np.add.at(gi[way], x[t], np.concatenate([ds, dv], 1))
                gs[way] += h.T @ du
                gb[way] += du.sum(0)
                back = dh * (1 - z) + du @ self.state[way].T
        return loss, grads


def train(x: np.ndarray, y: np.ndarray, labels: int, hidden: int = 8, epochs: int = 5, batch: int = 64, rate: float = 0.02, seed: int = 5) -> Net:
    """Fit a net to byte rows x (rows x time, 0 is padding) with labels y by Adam."""
    net, rng = Net.new(labels, hidden, seed), np.random.default_rng(seed)
    m = [np.zeros_like(p) for p in net.parameters()]
    v = [np.zeros_like(p) for p in net.parameters()]
    step, steps = 0, max(1, epochs * -(-len(x) // batch))
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i : i + batch]
            xt = np.ascontiguousarray(x[rows].T)
            _, grads = net.gradients(xt, y[rows], (xt > 0).astype(np.float32))
            step += 1
            lr = rate * (1 - 0.9 * step / steps)
            for p, g, a, b in zip(net.parameters(), grads, m, v, strict=True):
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                p -= lr * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-7)
    return net
