"""Training jobs: autoencoder by averaged local steps, joint objectives by full-batch gradients."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions.hashing import mix_uniform
from ...functions.vectors import batches_of, list_array, matrix, total_vectors, values
from ...session import check_broadcast, checkpoint
from ..geometry import rows_of, width
from ..kmeans import fit_kmeans
from .network import (
    Adam,
    AutoEncoder,
    divergence_gradient,
    info_nce,
    nearest_other,
    run_layers,
    sharpened,
    soft_assignment,
)

# Rows a training task may hold; more rows mean more shards, not bigger ones.
SHARD_ROWS = 131_072


@dataclass
class Shards:
    """The training table in fixed shards by row hash, so that runs repeat."""

    df: DataFrame
    n: int
    d: int
    parts: int

    def total(self, kernel, cells: int) -> np.ndarray:
        return total_vectors(self.df, kernel, [], cells=cells)[()]


def make_shards(df: DataFrame) -> Shards:
    n = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, n // 8192), math.ceil(n / SHARD_ROWS))
    fixed = df.select("row_id", "features").repartition(parts, "row_id").sortWithinPartitions("row_id")
    return Shards(checkpoint(fixed), n, width(df), parts)


@dataclass
class DeepFit:
    net: AutoEncoder
    centers: np.ndarray
    losses: list[float] = field(default_factory=list)

    def codes(self, df: DataFrame, *keep: str) -> DataFrame:
        """``(row_id, features)`` with the latent codes as features."""
        return encode(df, self.net, *keep)

    def labels(self, df: DataFrame, *keep: str) -> DataFrame:
        """The cluster with the largest soft assignment, which is the nearest centre."""
        net, centers = self.net, self.centers

        @F.arrow_udf("int")
        def hard(feats: pa.Array) -> pa.Array:
            return pa.array(soft_assignment(net.encode(rows_of(feats)), centers).argmax(1).astype(np.int32))

        return df.select(*(keep or ("row_id",)), hard("features").alias("cluster"))


def encode(df: DataFrame, net: AutoEncoder, *keep: str) -> DataFrame:
    @F.arrow_udf("array<double>")
    def code(feats: pa.Array) -> pa.Array:
        return list_array(net.encode(rows_of(feats)))

    return df.select(*(keep or ("row_id",)), code("features").alias("features"))


def reconstruct(df: DataFrame, net: AutoEncoder, *keep: str) -> DataFrame:
    @F.arrow_udf("array<double>")
    def decoded(feats: pa.Array) -> pa.Array:
        return list_array(net.decode(net.encode(rows_of(feats))))

    return df.select(*(keep or ("row_id",)), decoded("features").alias("features"))


def train_autoencoder(
    shards: Shards, *, latent: int = 10, hidden: tuple[int, ...] = (64, 32), epochs: int = 100, batch: int = 256, lr: float = 1e-3,
    seed: int = 42, local_epochs: int = 5,
) -> tuple[AutoEncoder, list[float]]:
    """Mini-batch Adam inside every shard, weights and moments averaged after ``local_epochs``.

    One Spark job per round instead of one per step. Returns the network and the mean squared
    error seen in each round.
    """
    net = AutoEncoder.start(shards.d, list(hidden), latent, seed)
    flat = net.flat
    check_broadcast(3 * flat.size, "network weights")
    m, v, steps = np.zeros_like(flat), np.zeros_like(flat), 0
    losses, done = [], 0
    while done < epochs:
        rounds = min(local_epochs, epochs - done)
        state = (flat, m, v, steps, done)

        def kernel(batches):
            w, m0, v0, t0, first = state
            parts = [matrix(b) for b in batches_of(batches)]
            if not parts:
                return
            x = np.concatenate(parts)
            opt, error = Adam(m0.copy(), v0.copy(), t0), 0.0
            shard = TaskContext.get().partitionId()
            for e in range(rounds):
                order = np.random.default_rng([seed, first + e, shard]).permutation(len(x))
                error = 0.0
                for at in range(0, len(x), batch):
                    xb = x[order[at : at + batch]]
                    loss, g = net.with_flat(w).reconstruction(xb, 1.0 / xb.size)
                    error += loss * len(xb)
                    w = opt.step(w, g, lr)
            n = len(x)
            yield (np.concatenate([[n, error, n * (opt.t - t0)], n * w, n * opt.m, n * opt.v]),)

        total = shards.total(kernel, 3 + 3 * flat.size)
        n = total[0]
        losses.append(float(total[1] / n))
        steps += int(round(total[2] / n))
        flat, m, v = (np.ascontiguousarray(p) for p in np.split(total[3:] / n, 3))
        v = np.maximum(v, 0.0)
        done += rounds
    return net.with_flat(flat), losses


def _latent_kmeans(shards: Shards, net: AutoEncoder, k: int, seed: int) -> np.ndarray:
    return fit_kmeans(encode(shards.df, net), k, seed=seed, n_init=20).centers


def fit_ae_kmeans(
    df: DataFrame, k: int, *, latent: int = 10, hidden: tuple[int, ...] = (64, 32), ae_epochs: int = 100, ft_epochs: int = 50,
    batch: int = 256, lr: float = 1e-3, seed: int = 42, recon_weight: float = 1.0, cluster_weight: float = 0.5,
) -> DeepFit:
    """Pretrain, cluster the codes, then tune codes towards their centres; centres follow slowly."""
    shards = make_shards(df)
    net, losses = train_autoencoder(shards, latent=latent, hidden=hidden, epochs=ae_epochs, batch=batch, lr=lr, seed=seed)
    centers = _latent_kmeans(shards, net, k, seed)
    flat, opt, n, d = net.flat, Adam.start(net.flat.size), shards.n, shards.d
    for _ in range(ft_epochs):
        now, mid = net.with_flat(flat), centers

        def kernel(batches):
            acc = None
            for b in batches_of(batches):
                x = matrix(b)
                loss, g = now.reconstruction(x, recon_weight / (n * d))
                enc = run_layers(x, now.encoder)
                z = enc[-1]
                dist = np.sqrt(np.maximum(((z[:, None] - mid[None]) ** 2).sum(2), 1e-24))
                near = dist.argmin(1)
                own = dist[np.arange(len(x)), near]
                gz = cluster_weight / n * (z - mid[near]) / own[:, None]
                g = g + now.latent_gradient(enc, gz)
                loss += cluster_weight / n * own.sum()
                onehot = (near[:, None] == np.arange(k)[None]).astype(float)
                part = np.concatenate([[loss], g, onehot.sum(0), (onehot.T @ z).ravel()])
                acc = part if acc is None else acc + part
            if acc is not None:
                yield (acc,)

        total = shards.total(kernel, 1 + flat.size + k + centers.size)
        losses.append(float(total[0]))
        g, rest = total[1 : 1 + flat.size], total[1 + flat.size :]
        sizes, sums = rest[:k], rest[k:].reshape(k, -1)
        flat = opt.step(flat, g, lr)
        fresh = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centers)
        centers = 0.9 * centers + 0.1 * fresh
    net = net.with_flat(flat)
    return DeepFit(net, _latent_kmeans(shards, net, k, seed), losses)


def draw_batches(shards: Shards, epochs: int, size: int, seed: int) -> list[np.ndarray]:
    """One bounded random batch of rows per epoch, all drawn in a single pass by hash."""
    n, d = shards.n, shards.d
    check_broadcast(2 * epochs * size * d, "contrastive batches")
    loose = 2.0 if n <= size else min(1.0, (size + 8 * math.sqrt(size) + 16) / n)

    def pick(batches):
        for b in batches_of(batches):
            x, ids = matrix(b), values(b, "row_id")
            for e in range(epochs):
                u = mix_uniform(ids, seed * 1_000_003 + e)
                hit = np.flatnonzero(u < loose)
                if len(hit):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(hit), e)), pa.array(u[hit]), list_array(x[hit])], names=["epoch", "u", "features"]
                    )

    t = shards.df.mapInArrow(pick, "epoch bigint, u double, features array<double>").toArrow()
    epoch, u = t.column("epoch").to_numpy(), t.column("u").to_numpy()
    x = t.column("features").combine_chunks().flatten().to_numpy().reshape(len(u), -1)
    order = np.lexsort((u, epoch))
    epoch, x = epoch[order], x[order]
    starts = np.searchsorted(epoch, np.arange(epochs + 1))
    return [x[starts[e] : min(starts[e + 1], starts[e] + size)] for e in range(epochs)]


def fit_dec(
    df: DataFrame, k: int, *, latent: int = 10, hidden: tuple[int, ...] = (64, 32), init_epochs: int = 100, dec_epochs: int = 150,
    update_interval: int = 5, tol: float = 1e-3, gamma: float = 1.0, batch: int = 256, lr: float = 1e-3, seed: int = 42,
    contrastive_weight: float = 0.0, temperature: float = 0.5, n_negatives: int = 1024, train_centers: bool = False,
) -> DeepFit:
    """Deep embedded clustering: sharpen soft assignments, with an optional contrastive term.

    The target is refreshed every ``update_interval`` epochs. It is never stored: tasks rebuild it
    from the weights of the last refresh and the k column masses. Without the contrastive term
    and with gamma < 1 the rest of the weight goes to reconstruction. Centres stay where K-means
    put them unless ``train_centers`` is set. Stops when a refresh moves fewer than ``tol`` of the
    labels.
    """
    shards = make_shards(df)
    net, _ = train_autoencoder(shards, latent=latent, hidden=hidden, epochs=init_epochs, batch=batch, lr=lr, seed=seed)
    centers = _latent_kmeans(shards, net, k, seed)
    flat, n, d = net.flat, shards.n, shards.d
    opt, opt_c = Adam.start(flat.size), Adam.start(centers.size)
    contrast = draw_batches(shards, dec_epochs, batch, seed) if contrastive_weight > 0 else None
    kl_weight = gamma if contrast or gamma < 1 else 1.0
    recon = 0.0 if contrast or gamma >= 1 else 1.0 - gamma
    anchor, anchor_c, mass, losses = flat, centers, None, []
    for epoch in range(dec_epochs):
        refresh = epoch % update_interval == 0
        if refresh:
            old, new, c_old, c_new = net.with_flat(anchor), net.with_flat(flat), anchor_c, centers

            def survey(batches):
                acc = np.zeros(k + 1)
                for b in batches_of(batches):
                    x = matrix(b)
                    q = soft_assignment(new.encode(x), c_new)
                    acc[:k] += q.sum(0)
                    acc[k] += (q.argmax(1) != soft_assignment(old.encode(x), c_old).argmax(1)).sum()
                yield (acc,)

            seen = shards.total(survey, k + 1)
            mass, moved = seen[:k], seen[k] / n
            anchor, anchor_c = flat, centers
        now, ref, c_now, c_ref, f = net.with_flat(flat), net.with_flat(anchor), centers, anchor_c, mass

        def kernel(batches):
            acc = None
            for b in batches_of(batches):
                x = matrix(b)
                p = sharpened(soft_assignment(ref.encode(x), c_ref), f)
                enc = run_layers(x, now.encoder)
                kl, gz = divergence_gradient(enc[-1], c_now, p)
                g = now.latent_gradient(enc, kl_weight / n * gz)
                loss = kl_weight / n * kl
                if recon > 0:
                    more, gr = now.reconstruction(x, recon / (n * d))
                    loss, g = loss + more, g + gr
                tail = np.zeros(0)
                if train_centers:
                    diff = enc[-1][:, None, :] - c_now[None]
                    kern = 1.0 / (1.0 + (diff * diff).sum(2))
                    q = kern / kern.sum(1, keepdims=True)
                    tail = (-2.0 * kl_weight / n * ((p - q)[:, :, None] * kern[:, :, None] * diff).sum(0)).ravel()
                part = np.concatenate([[loss], g, tail])
                acc = part if acc is None else acc + part
            if acc is not None:
                yield (acc,)

        total = shards.total(kernel, 1 + flat.size + centers.size)
        loss, g = float(total[0]), total[1 : 1 + flat.size]
        if contrast:
            enc = run_layers(contrast[epoch], now.encoder)
            extra, gz = info_nce(enc[-1], nearest_other(enc[-1]), temperature=temperature, n_negatives=n_negatives)
            loss += contrastive_weight * extra
            g = g + now.latent_gradient(enc, contrastive_weight * gz)
        flat = opt.step(flat, g, lr)
        if train_centers:
            centers = opt_c.step(centers.ravel(), total[1 + flat.size :], lr).reshape(centers.shape)
        losses.append(loss)
        if refresh and epoch > 0 and moved < tol:
            break
    return DeepFit(net.with_flat(flat), centers, losses)


def fit_dec_contrastive(df: DataFrame, k: int, *, contrastive_weight: float = 0.1, **options) -> DeepFit:
    return fit_dec(df, k, contrastive_weight=contrastive_weight, **options)
