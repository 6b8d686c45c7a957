"""A small fully connected autoencoder in NumPy, the per-task helper of the training jobs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def xavier(dims: list[int], rng: np.random.Generator) -> list[np.ndarray]:
    """Weight matrices with the bias as their last row."""
    out = []
    for a, b in zip(dims, dims[1:]):
        limit = np.sqrt(6.0 / (a + b))
        out.append(np.vstack([rng.uniform(-limit, limit, (a, b)), np.zeros((1, b))]))
    return out


def run_layers(x: np.ndarray, layers: list[np.ndarray]) -> list[np.ndarray]:
    """Input and the output of every layer; rectified except after the last."""
    acts = [x]
    for i, w in enumerate(layers):
        h = acts[-1] @ w[:-1] + w[-1]
        acts.append(np.maximum(h, 0.0) if i < len(layers) - 1 else h)
    return acts


def layer_gradients(acts: list[np.ndarray], layers: list[np.ndarray], out_grad: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    grads, g = [], out_grad
    for i in range(len(layers) - 1, -1, -1):
        if i < len(layers) - 1:
            g = g * (acts[i + 1] > 0)
        grads.append(np.vstack([acts[i].T @ g, g.sum(0, keepdims=True)]))
        g = g @ layers[i][:-1].T
    return grads[::-1], g


@dataclass
class AutoEncoder:
    encoder: list[np.ndarray]
    decoder: list[np.ndarray]

    @staticmethod
    def start(d: int, hidden: list[int], latent: int, seed: int) -> AutoEncoder:
        rng = np.random.default_rng(seed)
        dims = [d, *hidden, latent]
        return AutoEncoder(xavier(dims, rng), xavier(dims[::-1], rng))

    def encode(self, x: np.ndarray) -> np.ndarray:
        return run_layers(x, self.encoder)[-1]

    def decode(self, z: np.ndarray) -> np.ndarray:
        return run_layers(z, self.decoder)[-1]

    @property
    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in [*self.encoder, *self.decoder]])

    def with_flat(self, flat: np.ndarray) -> AutoEncoder:
        out, at = [], 0
        for w in [*self.encoder, *self.decoder]:
            out.append(flat[at : at + w.size].reshape(w.shape))
            at += w.size
        return AutoEncoder(out[: len(self.encoder)], out[len(self.encoder) :])

    def reconstruction(self, x: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
        """``scale`` times the summed squared error, and its gradient for all weights."""
        enc = run_layers(x, self.encoder)
        dec = run_layers(enc[-1], self.decoder)
        err = dec[-1] - x
        gd, gz = layer_gradients(dec, self.decoder, 2.0 * scale * err)
        ge, _ = layer_gradients(enc, self.encoder, gz)
        return scale * float((err * err).sum()), np.concatenate([g.ravel() for g in [*ge, *gd]])

    def latent_gradient(self, enc: list[np.ndarray], gz: np.ndarray) -> np.ndarray:
        """Gradient of the encoder for a given gradient at the codes; the decoder's part is zero."""
        ge, _ = layer_gradients(enc, self.encoder, gz)
        return np.concatenate([*[g.ravel() for g in ge], *[np.zeros(w.size) for w in self.decoder]])


@dataclass
class Adam:
    m: np.ndarray
    v: np.ndarray
    t: int = 0

    @staticmethod
    def start(size: int) -> Adam:
        return Adam(np.zeros(size), np.zeros(size))

    def step(self, w: np.ndarray, g: np.ndarray, lr: float) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        mh, vh = self.m / (1 - 0.9**self.t), self.v / (1 - 0.999**self.t)
        return w - lr * mh / (np.sqrt(vh) + 1e-8)


def soft_assignment(z: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Student-t similarity to each centre, normalised per row."""
    q = 1.0 / (1.0 + ((z[:, None, :] - centers[None]) ** 2).sum(2))
    return q / q.sum(1, keepdims=True)


def sharpened(q: np.ndarray, mass: np.ndarray) -> np.ndarray:
    p = q * q / mass
    return p / p.sum(1, keepdims=True)


def divergence_gradient(z: np.ndarray, centers: np.ndarray, p: np.ndarray) -> tuple[float, np.ndarray]:
    """Summed KL(p || q) and its gradient at the codes."""
    diff = z[:, None, :] - centers[None]
    kernel = 1.0 / (1.0 + (diff * diff).sum(2))
    q = kernel / kernel.sum(1, keepdims=True)
    loss = float((p * (np.log(np.maximum(p, 1e-300)) - np.log(q))).sum())
    return loss, 2.0 * ((p - q)[:, :, None] * kernel[:, :, None] * diff).sum(1)


def info_nce(z: np.ndarray, positive: np.ndarray, *, temperature: float = 0.5, n_negatives: int = 1024) -> tuple[float, np.ndarray]:
    """Mean contrastive loss of a batch and its gradient at the codes.

    Similarity is the cosine over the temperature. Each anchor is compared with its positive and
    its hardest negatives, never with itself.
    """
    b = len(z)
    norm = np.maximum(np.linalg.norm(z, axis=1), 1e-8)
    unit = z / norm[:, None]
    sim = unit @ unit.T / temperature
    rows = np.arange(b)
    open_ = np.ones((b, b), bool)
    open_[rows, rows] = False
    open_[rows, positive] = False
    neg = np.where(open_, sim, -np.inf)
    keep = min(n_negatives, b - 2)
    if 0 < keep < b - 2:
        cut = -np.partition(-neg, keep - 1, axis=1)[:, keep - 1 : keep]
        # ties at the cut are kept only up to the wanted number
        take = neg > cut
        room = keep - take.sum(1, keepdims=True)
        equal = (neg == cut) & open_
        take |= equal & (np.cumsum(equal, axis=1) <= room)
        neg = np.where(take, neg, -np.inf)
    elif keep <= 0:
        neg = np.full_like(sim, -np.inf)
    cand = neg.copy()
    cand[rows, positive] = sim[rows, positive]
    top = cand.max(1, keepdims=True)
    e = np.exp(cand - top)
    total = e.sum(1, keepdims=True)
    loss = float((top[:, 0] + np.log(total[:, 0]) - sim[rows, positive]).mean())
    g = e / total
    g[rows, positive] -= 1.0
    g = (g + g.T) / (b * temperature)
    gu = g @ unit
    return loss, (gu - (gu * unit).sum(1, keepdims=True) * unit) / norm[:, None]


def nearest_other(z: np.ndarray) -> np.ndarray:
    sq = (z * z).sum(1)
    d = sq[:, None] + sq[None, :] - 2.0 * z @ z.T
    np.fill_diagonal(d, np.inf)
    return d.argmin(1)
