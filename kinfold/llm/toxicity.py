"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import check_broadcast, checkpoint
from .common import bounded_batches, text_of

FILTER_BITS = 22
CHUNK = 1 << 18
TASKS = 8  # of the fit, which works on a bounded sample


@dataclass(frozen=True)
class Settings:
    """``orders``: lengths of the n-grams in characters. ``max_labelled``: labelled documents that the
    fit reads at most, drawn by a hash of their id. ``max_features``: n-grams kept, those with the
    most evidence for either class. ``min_docs``: documents that an n-gram must occur in."""

    orders: tuple[int, ...] = (4, 6, 8)
    max_labelled: int = 10_000
    max_features: int = 10_000
    min_docs: int = 4
    alpha: float = 1.0
    reg: float = 1e-3
    max_iter: int = 60


@dataclass(frozen=True)
class Model:
    """Sorted n-gram hashes with their weights (ratio times coefficient), and the intercept."""

    grams: np.ndarray
    weights: np.ndarray
    intercept: float
    settings: Settings = field(default_factory=Settings)


def gram_blocks(text: str, orders: tuple[int, ...]) -> Iterator[np.ndarray]:
    """64-bit hashes of all character n-grams of a lower-cased text, in blocks of bounded size."""
    reach = max(orders)
    text = f" {text.lower()} "
    for start in range(0, len(text), CHUNK):
        c = np.frombuffer(text[start : start + CHUNK + reach - 1].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        c = c.astype(np.uint64)
        h = c * np.uint64(0x9E3779B97F4A7C15)
        for n in range(2, reach + 1):
            if len(c) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c[n - 1 :]
            if n in orders:
                mixed = h * np.uint64(0x94D049BB133111EB)
                yield mixed[: min(len(mixed), CHUNK)]


def distinct_grams(text: str, orders: tuple[int, ...]) -> np.ndarray:
    found = [np.unique(b) for b in gram_blocks(text, orders)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)


def sample_of(labels: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` labels, those whose ids have the smallest hashes: the same on any cluster."""
    n = labels.count()
    if n > 4 * limit:  # twice the share that is needed leaves the smallest hashes in, and little to sort
        labels = labels.where(F.shiftrightunsigned(F.xxhash64("_lid"), 1) < int(2 * limit / n * (1 << 63)))
    return labels.orderBy(F.shiftrightunsigned(F.xxhash64("_lid"), 1), "_lid").limit(limit)


def _gram_counts(batches: Iterator[pd.DataFrame], orders: tuple[int, ...], most: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Documents per n-gram, all and toxic, summed over a task for as long as at most ``most`` n-grams are held."""

    def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[first], np.add.reduceat(counts, first)

    keys, counts = np.zeros(0, dtype=np.uint64), np.zeros((0, 2), dtype=np.int32)
    for rows in batches:
        grams = [distinct_grams(t, orders) for t in rows["_text"]]
        if not sum(map(len, grams)):
            continue
        y = np.repeat(rows["_y"].to_numpy().astype(np.int32), [len(g) for g in grams])
        new, n = summed(np.concatenate(grams), np.stack([y, np.ones_like(y)], axis=1))
        keys, counts = summed(np.concatenate([keys, new]), np.concatenate([counts, n]))
        if len(keys) > most:
            yield pd.DataFrame({"g": keys.view(np.int64), "pos": counts[:, 0], "n": counts[:, 1]})
            keys, counts = keys[:0], counts[:0]
    yield pd.DataFrame({"g": keys.view(np.int64), "pos": counts[:, 0], "n": counts[:, 1]})


def fit(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on the texts of ``labelled (_text, _y)``, ``_y`` 0 or 1, each text once; at most a drawn sample.
    Counts and gradients are sums over partitions.

    Without labels every score is 0; with one class only, every score is that class's share.
    Fitting minimises the logistic loss over the whole drawn sample with Spark's own solver.
    """
    s = settings
    bounded_batches(labelled.sparkSession)
    once = labelled.groupBy(F.md5("_text").alias("_h")).agg(F.first("_text").alias("_text"), F.max("_y").alias("_y"))
    # a sample of bounded size needs a fixed number of tasks, however many the session would use
    sample = checkpoint(once.coalesce(TASKS))
    size = sample.agg(F.count("*").alias("n"), F.sum("_y").alias("p")).first()
    none = np.zeros(0)
    if not size["n"] or size["p"] in (0, size["n"]):
        share = (size["p"] or 0) / size["n"] if size["n"] else 0.0
        return Model(none.astype(np.uint64), none, np.inf if share == 1 else -np.inf, s)
    p, q = size["p"], size["n"] - size["p"]
    counts = (
        sample.select("_text", "_y")
        .mapInPandas(lambda it: _gram_counts(it, s.orders), "g long, pos int, n int")
        .groupBy("g").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
        .where(F.col("n") >= s.min_docs)
        .coalesce(TASKS)
    )
    # log of the ratio of smoothed shares, and how far the count lies from its expectation
    ratio = F.log((F.col("pos") + s.alpha) / (p + s.alpha)) - F.log((F.col("n") - F.col("pos") + s.alpha) / (q + s.alpha))
    expected = F.col("n") * (p / (p + q))
    evidence = F.abs(F.col("pos") - expected) / F.sqrt(expected * (q / (p + q)))
    best = counts.select("g", ratio.alias("r"), evidence.alias("e")).orderBy(F.desc("e"), "g").limit(s.max_features)
    chosen = checkpoint(best).toPandas()  # at most max_features rows
    grams = chosen["g"].to_numpy().view(np.uint64)
    order = np.argsort(grams)
    grams, r = grams[order], chosen["r"].to_numpy()[order]
    if not len(grams):
        return Model(grams, none, float(np.log(p / q)), s)
    check_broadcast(len(grams) * 2, "n-gram weights")
    shared = labelled.sparkSession.sparkContext.broadcast((grams, r))
    orders, width = s.orders, len(grams)

    @F.udf(VectorUDT())
    def vector(text):
        keys, ratios = shared.value
        at = np.flatnonzero(np.isin(keys, distinct_grams(text, orders), assume_unique=True))
        return Vectors.sparse(width, at.tolist(), ratios[at].tolist())

    data = checkpoint(sample.select(vector("_text").alias("features"), F.col("_y").cast("double").alias("label")))
    solver = LogisticRegression(maxIter=s.max_iter, regParam=s.reg, standardization=False)
    fitted = solver.fit(data.persist())
    data.unpersist()
    shared.destroy()
    return Model(grams, r * fitted.coefficients.toArray(), float(fitted.intercept), s)


def scorer(model: Model, spark):
    """Column function: text to a score between 0 and 1."""
    check_broadcast(len(model.grams) * 2, "n-gram weights")
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        known = np.zeros(1 << FILTER_BITS, dtype=bool)
        shift = np.uint64(64 - FILTER_BITS)
        known[m.grams >> shift] = True

        def one(text: str) -> float:
            z = m.intercept
            hits = [h[known[h >> shift]] for h in gram_blocks(text, m.settings.orders)] if len(m.grams) else []
            if hits:
                got = np.unique(np.concatenate(hits))
                at = np.minimum(np.searchsorted(m.grams, got), len(m.grams) - 1)
                z += m.weights[at[m.grams[at] == got]].sum()
            return 0.0 if z == -np.inf else float(1 / (1 + np.exp(-np.clip(z, -700, 700))))

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return score


def label_table(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``(_lid, _y)``: one label per document, the higher one if several disagree; null labels are none."""
    y = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_lid"))
    return y.agg(F.max((F.col(label_col) > 0).cast("int")).alias("_y"))


def held_out(id_col: str):
    """Documents whose label is never learned from. A null id is none of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", settings: Settings = Settings()) -> Model:
    """Labels are drawn before they meet the texts, so the join is a broadcast of ``max_labelled`` rows at most."""
    drawn = sample_of(label_table(labels).where("_lid IS NOT NULL").where(~held_out("_lid")), settings.max_labelled)
    check_broadcast(settings.max_labelled * 2, "drawn labels")
    rows = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    return fit(rows.join(F.broadcast(drawn), F.col("_id") == F.col("_lid")).select("_text", "_y"), settings)


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = 0.3, settings: Settings = Settings(),
) -> DataFrame:
    """``(id, held_out, score, predicted)`` for every document, from its whole text alone.

    Null text is empty text, which scores by the intercept. Rows that repeat an id or a text score
    alike. An empty table gives no rows; without labels every score is 0.
    """
    s = scorer(train(docs, labels, id_col, text_col, settings), docs.sparkSession)
    scored = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), s(text_of(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", threshold=0.3, settings=Settings()) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    s = scorer(train(docs, labels, id_col, text_col, settings), docs.sparkSession)
    return docs.where(s(text_of(text_col)) < threshold)
