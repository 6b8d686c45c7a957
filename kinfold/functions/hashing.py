"""Deterministic uniform numbers from row identity, so samples repeat on any partitioning."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def u01(row_id: Column | str, tag: str, seed: int = 0) -> Column:
    """Uniform number in [0, 1) from 32 bits of md5(row_id:tag:seed)."""
    key = F.concat(F.col(row_id) if isinstance(row_id, str) else row_id, F.lit(f":{tag}:{seed}"))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def u01_local(row_id, tag: str, seed: int = 0) -> float:
    return int(hashlib.md5(f"{row_id}:{tag}:{seed}".encode()).hexdigest()[:8], 16) / 4294967296.0


def mix_uniform(ids: np.ndarray, seed: int) -> np.ndarray:
    """Vectorised uniform numbers for int64 ids inside a task (SplitMix64 finaliser)."""
    with np.errstate(over="ignore"):
        z = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) / float(2**53)


def poisson_weights(ids: np.ndarray, rate: float, seed: int) -> np.ndarray:
    """Bootstrap multiplicities: each row drawn Poisson(rate) times, with no shuffle."""
    terms = [np.exp(-rate)]
    while sum(terms) < 1 - 1e-15 and len(terms) < 200:
        terms.append(terms[-1] * rate / len(terms))
    return np.searchsorted(np.cumsum(terms), mix_uniform(ids, seed), side="right").astype(np.float64)
