"""Row-wise features and scaling. Parameters are fitted once, then applied as plain projections."""

from __future__ import annotations

import math

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import exact_quantiles


def engineered(time: str = "time", amount: str = "amount", period: float = 86400.0) -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * F.col(time) / F.lit(float(period))
    return {"log_amount": F.log1p(amount), "time_sin": F.sin(angle), "time_cos": F.cos(angle)}


def build_features(
    df: DataFrame, keep: list[str], *, time: str = "time", amount: str = "amount", period: float = 86400.0
) -> DataFrame:
    """Kept columns as they are, then the log amount and the position on the daily circle."""
    return df.select(*keep, *[c.alias(n) for n, c in engineered(time, amount, period).items()])


class FeatureBuilder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The same projection as a pipeline stage; stateless, so fitting is a no-op. Saved with all its settings."""

    keep = Param(Params._dummy(), "keep", "columns kept as they are", TypeConverters.toListString)
    time = Param(Params._dummy(), "time", "column of seconds", TypeConverters.toString)
    amount = Param(Params._dummy(), "amount", "column whose logarithm is taken", TypeConverters.toString)
    period = Param(Params._dummy(), "period", "seconds of one round of the circle", TypeConverters.toFloat)

    def __init__(self, keep=(), time="time", amount="amount", period=86400.0):
        super().__init__()
        self._set(keep=list(keep), time=time, amount=amount, period=period)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return build_features(
            dataset, get(self.keep), time=get(self.time), amount=get(self.amount), period=get(self.period)
        )

    def feature_names_out(self) -> list[str]:
        return [*self.getOrDefault(self.keep), "log_amount", "time_sin", "time_cos"]


def cyclic_phase(sin: str = "time_sin", cos: str = "time_cos") -> Column:
    return F.atan2(F.col(sin), F.col(cos))


def fit_standard(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation; a constant column is divided by 1."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def fit_robust(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Median and inter-quartile range; a zero range is replaced by 1."""
    qs = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return {c: (q[1], (q[2] - q[0]) or 1.0) for c, q in qs.items()}


def fit_scaler(
    df: DataFrame, strategy: str, standard: list[str], robust: list[str]
) -> dict[str, tuple[float, float]]:
    """Centre and scale per column for 'standard', 'robust' or 'hybrid'; other columns are dropped."""
    if strategy == "standard":
        return fit_standard(df, standard + robust)
    if strategy == "robust":
        return fit_robust(df, standard + robust)
    if strategy == "hybrid":
        return {
            **(fit_standard(df, standard) if standard else {}),
            **(fit_robust(df, robust) if robust else {}),
        }
    raise ValueError(f"unknown scaling strategy {strategy!r}")


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]], *keep: str) -> DataFrame:
    return df.select(*keep, *[((F.col(c) - F.lit(m)) / F.lit(s)).alias(c) for c, (m, s) in params.items()])


def scale(df: DataFrame, strategy: str, standard: list[str], robust: list[str], *keep: str) -> DataFrame:
    return apply_scaler(df, fit_scaler(df, strategy, standard, robust), *keep)


def compare_scalings(df: DataFrame, standard: list[str], robust: list[str]) -> DataFrame:
    """Per strategy: spread of the amount column and mean and sample deviation of the first standard one."""
    target = robust[0] if robust else standard[-1]
    first = standard[0]
    out = None
    for strategy in ("standard", "robust", "hybrid"):
        scaled = scale(df, strategy, standard, robust)
        q = exact_quantiles(scaled, [target], [0.25, 0.75])[target]
        row = scaled.agg(F.avg(first).alias("first_mean"), F.stddev_samp(first).alias("first_std")).select(
            F.lit(strategy).alias("strategy"), F.lit(q[1] - q[0]).alias("amount_iqr"), "first_mean", "first_std"
        )
        out = row if out is None else out.unionByName(row)
    return out
