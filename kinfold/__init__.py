"""Group-structure analytics on Spark: prepare, cluster, score, explain, audit and monitor tables."""

__version__ = "0.1.0"
