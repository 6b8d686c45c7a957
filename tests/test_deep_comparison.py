from pyspark.sql import functions as F

from kinfold.plans import catalog
from kinfold.plans.settings import Settings


def test_deep_comparison_trains_with_the_whole_settings(spark, sf, monkeypatch):
    """Four epochs on 2,000 rows never refreshed the target of the embedded clustering."""
    seen = {}

    def plan(df, labels, names, preferred, clock, out, settings=Settings()):
        seen.update(rows=df.count(), settings=settings)
        return {"track": spark.range(1).withColumn("runtime_s", F.lit(0.0))}

    monkeypatch.setattr(catalog.deep_audit, "deep_and_audit", plan)
    catalog.QUERIES["deep_comparison"](spark, sf).collect()
    used, whole = seen["settings"], Settings()
    for name in ("train_n", "latent", "hidden", "ae_epochs", "ft_epochs", "dec_epochs", "replicates", "silhouette_sample"):
        assert getattr(used, name) == getattr(whole, name), name
    assert used.dec_epochs == 150 and seen["rows"] == spark.read.parquet(f"{sf}/events.parquet").count()
