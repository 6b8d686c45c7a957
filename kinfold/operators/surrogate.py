"""A small decision tree that mimics a clustering, and what can be read from it."""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import batches_of, list_array, matrix, total_vectors, values
from ..session import bounded_rows
from .sampling import simple_sample


@dataclass(frozen=True)
class Leaf:
    index: int
    path: tuple[tuple[int, bool, float], ...]  # (feature, is the <= side, threshold) from the root
    shares: np.ndarray  # class shares at the leaf


@dataclass(frozen=True)
class SurrogateTree:
    classes: tuple[int, ...]
    features: tuple[str, ...]
    leaves: tuple[Leaf, ...]

    def _test(self, leaf: Leaf, f: Column) -> Column:
        test = F.lit(True)
        for feature, low, cut in leaf.path:
            test = test & ((f[feature] <= F.lit(cut)) if low else (f[feature] > F.lit(cut)))
        return test

    def leaf_column(self, features: str = "features") -> Column:
        """Index of the leaf a row falls into, as compiled comparisons."""
        out = F.lit(None).cast("int")
        for leaf in self.leaves:
            out = F.when(self._test(leaf, F.col(features)), F.lit(leaf.index)).otherwise(out)
        return out

    def predict_column(self, features: str = "features") -> Column:
        out = F.lit(None).cast("bigint")
        for leaf in self.leaves:
            winner = self.classes[int(leaf.shares.argmax())]
            out = F.when(self._test(leaf, F.col(features)), F.lit(winner)).otherwise(out)
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), dtype=np.int64)
        for leaf in self.leaves:
            hit = np.ones(len(x), bool)
            for feature, low, cut in leaf.path:
                hit &= (x[:, feature] <= cut) if low else (x[:, feature] > cut)
            out[hit] = self.classes[int(leaf.shares.argmax())]
        return out

    def conditions(self, leaf: Leaf) -> list[str]:
        # fixed values: the text format of a rule's conditions
        return [f"{self.features[f]} {'<= ' if low else '>  '}{cut:.4f}" for f, low, cut in leaf.path]


def fit_surrogate(
    df: DataFrame, names: list[str] | None = None, *, max_depth: int = 4, min_leaf: int = 50, max_bins: int = 128, seed: int = 0
) -> SurrogateTree:
    """Fit on non-noise rows; class shares at the leaves are recounted exactly."""
    live = df.where("cluster <> -1").select("features", F.col("cluster").cast("bigint").alias("cluster"))
    classes = tuple(sorted(r["cluster"] for r in bounded_rows(live.select("cluster").distinct(), 10_000, "classes")))
    if not classes:
        raise ValueError("no non-noise rows to explain")
    code = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))]), F.col("cluster"))
    train = live.select(array_to_vector("features").alias("v"), code.alias("y"))
    model = DecisionTreeClassifier(
        featuresCol="v", labelCol="y", maxDepth=max_depth, minInstancesPerNode=min_leaf, maxBins=max_bins, impurity="gini", seed=seed
    ).fit(train)
    paths: list[tuple] = []

    def walk(node, path):
        if node.subtreeDepth() == 0:
            paths.append(tuple(path))
            return
        split = node.split()
        f, cut = split.featureIndex(), float(split.threshold())
        walk(node.leftChild(), [*path, (f, True, cut)])
        walk(node.rightChild(), [*path, (f, False, cut)])

    walk(model._java_obj.rootNode(), [])
    if names is None:
        names = [f"x{i}" for i in range(model.numFeatures)]
    bare = SurrogateTree(classes, tuple(names), tuple(Leaf(i, p, np.ones(len(classes))) for i, p in enumerate(paths)))
    counts = live.groupBy(bare.leaf_column().alias("leaf"), "cluster").count()
    shares = np.zeros((len(paths), len(classes)))
    for r in bounded_rows(counts, 1_000_000, "leaf counts"):
        shares[r["leaf"], classes.index(r["cluster"])] = r["count"]
    return SurrogateTree(classes, tuple(names), tuple(Leaf(i, p, shares[i]) for i, p in enumerate(paths)))


def tree_rules(spark, tree: SurrogateTree) -> DataFrame:
    """``(leaf, cluster, rule, conditions, support, precision)``: one rule per leaf, largest first."""
    rows = []
    for leaf in tree.leaves:
        total, cond = float(leaf.shares.sum()), tree.conditions(leaf)
        win = int(leaf.shares.argmax())
        rows.append((leaf.index, tree.classes[win], " AND ".join(cond), cond, int(total), float(leaf.shares[win] / total) if total else 0.0))
    schema = "leaf int, cluster bigint, rule string, conditions array<string>, support bigint, precision double"
    return spark.createDataFrame(rows, schema).orderBy(F.desc("support"), "leaf")


def fidelity(df: DataFrame, tree: SurrogateTree) -> DataFrame:
    hit = F.when(tree.predict_column() == F.col("cluster"), 1.0).otherwise(0.0)
    return df.where("cluster <> -1").agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n_rows"))


def _patterns(tree: SurrogateTree, leaf: Leaf) -> tuple[list[int], dict[int, tuple[float, float]]]:
    """Features on the path, each with the one interval its conditions amount to."""
    span: dict[int, tuple[float, float]] = {}
    for f, low, cut in leaf.path:
        a, b = span.get(f, (-math.inf, math.inf))
        span[f] = (a, min(b, cut)) if low else (max(a, cut), b)
    return sorted(span), span


def _codes(x: np.ndarray, feats: list[int], span: dict) -> np.ndarray:
    """Bit j set when the j-th path feature of a row lies inside the leaf's interval."""
    code = np.zeros(len(x), dtype=np.int64)
    for j, f in enumerate(feats):
        a, b = span[f]
        code |= ((x[:, f] > a) & (x[:, f] <= b)).astype(np.int64) << j
    return code


def _leaf_tables(tree: SurrogateTree, background: np.ndarray) -> list[tuple]:
    """Per leaf: how much each path feature adds, for every way a row can meet the conditions.

    A feature that only the row satisfies gains the leaf's value, one that only the background
    satisfies loses it, weighted by the Shapley weights of those two sets; the leaf is out of
    reach if neither side satisfies a condition. Averaged over the background beforehand, the
    attribution of a row is a table lookup per leaf.
    """
    out = []
    for leaf in tree.leaves:
        feats, span = _patterns(tree, leaf)
        m, value = len(feats), leaf.shares / max(leaf.shares.sum(), 1.0)
        freq = np.bincount(_codes(background, feats, span), minlength=2**m) / len(background)
        table = np.zeros((2**m, m))
        for xp, zp in itertools.product(range(2**m), range(2**m)):
            if freq[zp] == 0 or (xp | zp) != 2**m - 1:
                continue
            mine = [j for j in range(m) if xp >> j & 1 and not zp >> j & 1]
            theirs = [j for j in range(m) if zp >> j & 1 and not xp >> j & 1]
            a, b = len(mine), len(theirs)
            for j in mine:
                table[xp, j] += freq[zp] * math.factorial(a - 1) * math.factorial(b) / math.factorial(a + b)
            for j in theirs:
                table[xp, j] -= freq[zp] * math.factorial(a) * math.factorial(b - 1) / math.factorial(a + b)
        out.append((feats, span, table, value))
    return out


def attributions(x: np.ndarray, tables: list[tuple], d: int, classes: int) -> np.ndarray:
    phi = np.zeros((len(x), d, classes))
    for feats, span, table, value in tables:
        if feats:
            phi[:, feats, :] += table[_codes(x, feats, span)][:, :, None] * value
    return phi


def background_rows(df: DataFrame, n: int = 200, seed: int = 0) -> np.ndarray:
    t = simple_sample(df.select("row_id", "features"), n, tag="background", seed=seed).orderBy("row_id").toArrow()
    return t.column("features").combine_chunks().flatten().to_numpy().astype(float).reshape(t.num_rows, -1)


def shap_importance(df: DataFrame, tree: SurrogateTree, *, background: int = 200, seed: int = 0) -> DataFrame:
    """``(cluster, feature, mean_abs_shap)``: exact interventional attributions, averaged in the tasks."""
    bg = background_rows(df, background, seed)
    tables, d, k = _leaf_tables(tree, bg), bg.shape[1], len(tree.classes)

    def kernel(batches):
        acc, n = np.zeros((d, k)), 0
        for b in batches_of(batches):
            x = matrix(b)
            acc += np.abs(attributions(x, tables, d, k)).sum(0)
            n += len(x)
        yield (np.r_[n, acc.ravel()],)

    vec = total_vectors(df.select("features"), kernel, [], cells=1 + d * k)[()]
    mean = vec[1:].reshape(d, k) / vec[0]
    rows = [(c, tree.features[j], float(mean[j, i])) for i, c in enumerate(tree.classes) for j in range(d)]
    return df.sparkSession.createDataFrame(rows, "cluster bigint, feature string, mean_abs_shap double")


def counterfactuals(
    queries: DataFrame, tree: SurrogateTree, target: int, box: list[tuple[float, float]], *, total: int = 3, vary: list[str] | None = None
) -> DataFrame:
    """``(row_id, found, rank, features, distance)``: the least changes that make the tree put a row into ``target``.

    A leaf of the target is a box, and the point of a box nearest to a row is known in closed form: every feature
    moves to the near side of its interval or stays. Ranks are over the target's leaves, so the first is the nearest
    of all points. Distances are in widths of the data's ``box``. Features that may not vary have to fit a leaf as
    they are; a row that fits none has one row, not ``found``.
    """
    d, idx = len(tree.features), [tree.features.index(f) for f in (vary or list(tree.features))]
    fixed = np.setdiff1d(np.arange(d), idx)
    width = np.array([b - a if b > a else 1.0 for a, b in box])
    leaves = [leaf for leaf in tree.leaves if tree.classes[int(leaf.shares.argmax())] == target]
    low, high = np.full((len(leaves), d), -np.inf), np.full((len(leaves), d), np.inf)
    for i, leaf in enumerate(leaves):
        for f, (a, b) in _patterns(tree, leaf)[1].items():
            low[i, f], high[i, f] = a, b
    above = np.nextafter(low, np.inf)  # intervals are open below

    def nearest(x: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        moved = np.where(x[:, None, :] > high, high, np.where(x[:, None, :] <= low, above, x[:, None, :]))
        distance = np.sqrt((((moved - x[:, None, :]) / width) ** 2).sum(axis=2))
        distance[(moved != x[:, None, :])[:, :, fixed].any(axis=2)] = np.inf
        order = np.argsort(distance, axis=1, kind="stable")[:, :total]
        best = np.take_along_axis(distance, order, axis=1)
        row, rank = np.nonzero(np.isfinite(best))
        alone = np.setdiff1d(np.arange(len(x)), row)
        points = np.concatenate([moved[row, order[row, rank]], x[alone]])
        blank = np.arange(len(points)) >= len(row)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[np.r_[row, alone]]), pa.array(~blank), pa.array(np.r_[rank + 1, np.zeros(len(alone))].astype(np.int32), mask=blank),
                list_array(points), pa.array(np.r_[best[row, rank], np.zeros(len(alone))], mask=blank),
            ],
            names=["row_id", "found", "rank", "features", "distance"],
        )

    def run(batches):
        step = max(1, (1 << 20) // max(1, len(leaves) * d))
        for b in batches_of(batches):
            x, ids = matrix(b), values(b, "row_id")
            for at in range(0, len(x), step):
                yield nearest(x[at : at + step], ids[at : at + step])

    return queries.select(F.col("row_id").cast("bigint").alias("row_id"), "features").mapInArrow(
        run, "row_id bigint, found boolean, rank int, features array<double>, distance double"
    )
