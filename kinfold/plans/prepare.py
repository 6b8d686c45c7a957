"""From a raw transaction table to clean, scaled and reduced feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import pack
from ..operators import cleaning, features, geometry, linkage, tendency
from ..sources import contracts, files
from .settings import Settings


def prepare_tables(
    raw: DataFrame, out: str, *, columns: list[str], time: str, amount: str, label: str, settings: Settings = Settings(),
    contract: contracts.Contract | None = None,
) -> dict[str, DataFrame]:
    """Validate, de-duplicate, build features, scale, reduce and test for structure.

    ``raw`` carries ``row_id``. Every stage is written once and read back, so that a later stage
    never recomputes an earlier one. The label goes into its own table before anything is fitted.
    """
    spark: SparkSession = raw.sparkSession
    if contract is not None:
        contracts.validate(raw.drop("row_id"), contract)

    def store(df: DataFrame, name: str) -> DataFrame:
        files.write_parquet(df, f"{out}/{name}")
        return files.read_parquet(spark, f"{out}/{name}")

    clean = store(cleaning.drop_exact_duplicates(raw), "clean")
    stats = store(cleaning.cleaning_stats(raw, clean, label), "stats")
    unlabelled, labels = cleaning.isolate_label(clean, label)
    labels = store(labels.withColumnRenamed(label, "class"), "labels")
    built = features.build_features(unlabelled, ["row_id", *columns], time=time, amount=amount, period=settings.period)
    built = store(built, "features")
    robust = ["log_amount", "time_sin", "time_cos"]
    scaled = features.scale(built, settings.scaling, columns, robust, "row_id")
    scaled = store(pack(scaled, [*columns, *robust], "row_id"), "scaled")
    model = geometry.fit_pca(scaled, settings.pca_variance)
    reduced = store(model.project(scaled), "reduced")
    gate = tendency.repeated_hopkins(
        reduced, repeats=settings.hopkins_repeats, sample_size=settings.hopkins_probes, threshold=settings.hopkins_threshold, seed=settings.seed
    )
    gate = store(gate, "tendency")
    picture = tendency.vat_order(tendency.prototype_rows(spark, linkage.prototypes(reduced, m=settings.vat_prototypes)))
    return {
        "clean": clean, "stats": stats, "labels": labels, "features": built, "scaled": scaled, "reduced": reduced,
        "tendency": gate, "variance": store(geometry.variance_curve(spark, model), "variance"), "vat": store(picture, "vat"),
    }


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in sorted(tables.items()):
        one = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out
