"""One-layer convolutional networks over symbol sequences, in numpy: embedding,
filters of several widths, max pooling, and a softmax or sigmoid on top.

Filters of all widths are one matrix product over the widest window; a narrower
filter's further weights stay zero. Only the place where a filter is largest
receives a gradient, so a training step touches few positions.
"""

from __future__ import annotations

import numpy as np


#: Slope below 0, so that no filter can die.
LEAK = np.float32(0.1)
#: Rows of symbols whose patches are held at once in training.
BLOCK = 128


class Adam:
    """Adam for a list of arrays, changed in place."""

    def __init__(self, arrays: list[np.ndarray], rate: float):
        self.arrays, self.rate, self.t = arrays, rate, 0
        self.m = [np.zeros_like(a) for a in arrays]
        self.v = [np.zeros_like(a) for a in arrays]

    def step(self, grads: list[np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for a, g, m, v in zip(self.arrays, grads, self.m, self.v):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= scale * m / (np.sqrt(v) + 1e-7)


class ConvNet:
    """``symbols``: sizes of the embedding tables; a position's embedding is the
    sum of one row from each. Row 0 of each table is the padding and stays
    zero."""

    def __init__(self, symbols: list[int], dim: int, widths: tuple[int, ...], filters: int, classes: int, seed: int = 0):
        rnd = np.random.default_rng(seed)
        self.dim, self.widths, self.wide, self.classes = dim, widths, max(widths), classes
        self.tables = [rnd.normal(0, 0.3, (n, dim)).astype("f4") for n in symbols]
        for t in self.tables:
            t[0] = 0
        total = filters * len(widths)
        self.kernel = np.zeros((self.wide * dim, total), "f4")
        self.mask = np.zeros_like(self.kernel)
        for k, w in enumerate(widths):
            part = slice(k * filters, (k + 1) * filters)
            self.mask[: w * dim, part] = 1
            self.kernel[: w * dim, part] = rnd.normal(0, (w * dim) ** -0.5, (w * dim, filters))
        self.bias = np.zeros(total, "f4")
        self.top = rnd.normal(0, total**-0.5, (total, classes)).astype("f4")
        self.top_bias = np.zeros(classes, "f4")

    def _patches(self, inputs: list[np.ndarray]) -> np.ndarray:
        """[texts, positions, widest window x dim] of padded symbol arrays."""
        e = self.tables[0][inputs[0]]
        for t, x in zip(self.tables[1:], inputs[1:]):
            e += t[x]
        n, length, dim = e.shape
        s = e.strides
        view = np.lib.stride_tricks.as_strided(e, (n, length - self.wide + 1, self.wide * dim), (s[0], s[1], s[2]))
        return np.ascontiguousarray(view)

    def pooled(self, inputs: list[np.ndarray]) -> np.ndarray:
        """Each filter's largest response (a tenth of it below 0)."""
        p = self._patches(inputs)
        out = (p.reshape(-1, p.shape[2]) @ self.kernel).reshape(*p.shape[:2], -1)
        z = out.max(1) + self.bias
        return np.maximum(z, LEAK * z)

    def _largest(self, inputs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each filter's largest response in each row (without bias), its place,
        and the patch there [rows, filters, window x dim], block by block."""
        parts = []
        for lo in range(0, len(inputs[0]), BLOCK):
            p = self._patches([x[lo : lo + BLOCK] for x in inputs])
            n, length, width = p.shape
            out = (p.reshape(-1, width) @ self.kernel).reshape(n, length, -1)
            at = out.argmax(1)
            parts.append((np.take_along_axis(out, at[:, None], 1)[:, 0], at, p[np.arange(n)[:, None], at]))
        return tuple(np.concatenate(c) for c in zip(*parts))

    def logits(self, inputs: list[np.ndarray]) -> np.ndarray:
        return self.pooled(inputs) @ self.top + self.top_bias

    def train(self, draw, steps: int, rate: float = 0.003, decay: float = 1e-5) -> ConvNet:
        """``draw(step)``: (padded symbol arrays, target distribution
        [texts, classes], weights [texts]) and, where a text has several rows
        of symbols, the first row of each text; a filter then takes the largest
        response of all rows. A net of one class is a sigmoid."""
        adam = Adam([self.kernel, self.bias, self.top, self.top_bias], rate)
        moments = [(np.zeros_like(t), np.zeros_like(t)) for t in self.tables]
        for step in range(steps):
            inputs, target, weight, *starts = draw(step)
            most, at, best = self._largest(inputs)
            n = len(target)
            row = np.broadcast_to(np.arange(len(most))[:, None], most.shape)
            if starts:
                top = np.maximum.reduceat(most, starts[0])
                owner = np.repeat(np.arange(n), np.diff(np.append(starts[0], len(most))))
                row = np.minimum.reduceat(np.where(most == top[owner], row, len(most)), starts[0])
                filters = np.arange(top.shape[1])
                most, at, best = top, at[row, filters], best[row, filters]
            z = most + self.bias
            a = np.maximum(z, LEAK * z)
            logit = a @ self.top + self.top_bias
            if self.classes == 1:
                prob = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            else:
                prob = np.exp(logit - logit.max(1, keepdims=True))
                prob /= prob.sum(1, keepdims=True)
            d = ((prob - target) * weight[:, None] / weight.sum()).astype("f4")
            dz = (d @ self.top.T) * np.where(z > 0, np.float32(1), LEAK)
            d_kernel = np.einsum("nf,nfk->kf", dz, best) * self.mask + decay * self.kernel
            d_patch = dz[:, :, None] * self.kernel.T[None]
            adam.step([d_kernel, dz.sum(0), a.T @ d + decay * self.top, d.sum(0)])
            place = at[:, :, None] + np.arange(self.wide)
            d_embed = d_patch.reshape(n, -1, self.wide, self.dim).reshape(-1, self.dim)
            for t, x, (m, v) in zip(self.tables, inputs, moments):
                rows = x[row[:, :, None], place].ravel()
                own, back = np.unique(rows, return_inverse=True)
                g = np.zeros((len(own), self.dim), "f4")
                np.add.at(g, back, d_embed)
                g[own == 0] = 0
                m[own] = 0.9 * m[own] + 0.1 * g
                v[own] = 0.99 * v[own] + 0.01 * g * g
                t[own] -= rate * m[own] / (np.sqrt(v[own]) + 1e-6)
            for t in self.tables:
                t[0] = 0
        return self
