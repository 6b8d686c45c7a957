"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import check_broadcast, checkpoint

# Sources whose rates may be broadcast; with more of them the rates are joined under salted keys.
BROADCAST_SOURCES = 10_000
SALTS = 32
# A rate above this is split into equal parts that are drawn independently; their sum has the same law.
RATE_STEP = 16.0
# Terms of the distribution function that are kept: at rate 16 the rest is below 2 ** -52.
TERMS = 80


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) of 52 bits, from the md5 of the parts: the same on every engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def distribution(rate: Column, terms: int = TERMS) -> Column:
    """Values of the Poisson distribution function at 0, 1, 2, ..."""
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def step(s, k):
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(terms - 1)), start, step, lambda s: s["all"])


def source_rates(
    docs: DataFrame, weights: Mapping[str | None, float] | None, alpha: float, size_ratio: float,
    source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """``(_source, _size, _rate, _parts, _cdf)`` per source: size in characters, mean number of copies per document."""
    size = F.sum(F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).cast("long") + 1)  # one for the separator
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("_source")).agg(size.alias("_size"))
    if weights is None:
        wanted = F.pow(F.col("_size").cast("double"), F.lit(alpha))
    else:
        pairs = [x for k, w in weights.items() if k is not None for x in (F.lit(k), F.lit(float(w)))]
        known = F.coalesce(F.create_map(*pairs)[F.col("_source")], F.lit(0.0)) if pairs else F.lit(0.0)
        wanted = F.when(F.col("_source").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(known)
    sizes = checkpoint(sizes.withColumn("_w", wanted))
    total = sizes.agg(F.sum("_size").alias("n"), F.sum("_w").alias("w")).first()
    if not total["w"]:
        return sizes.select("_source", "_size", F.lit(0.0).alias("_rate"), F.lit(1).alias("_parts"), F.array(F.lit(1.0)).alias("_cdf"))
    # digits beyond the tenth depend on the order of a sum; without them every plan draws alike
    rate = F.round(F.col("_w") / total["w"] * size_ratio * total["n"] / F.col("_size"), 10)
    rated = sizes.withColumn("_rate", rate).withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("_rate") / RATE_STEP).cast("int")))
    return rated.withColumn("_cdf", distribution(F.col("_rate") / F.col("_parts"))).drop("_w")


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, alpha: float = 0.5, size_ratio: float = 1.0,
    seed: int = 17, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """The documents, each repeated a Poisson number of times, in a random global order.

    The mean number of copies of a source's documents is its target share of ``size_ratio`` times the
    whole size, over its own size (characters, and one per document). Targets are ``weights`` per
    source (a source that is not named gets none; negative weights are refused), or else sizes to the
    power ``alpha``. A document's number is read off the distribution function at a hash of its id, so
    it is the same on every run and partitioning. Copies are numbered in ``mix_copy`` from 1 and
    dealt to partitions by ``mix_key``, a hash of id and copy, by which each partition is sorted.

    The rates travel as a broadcast only while there are at most BROADCAST_SOURCES sources; beyond it
    they are joined on source and salt, so that a hot source is spread. Null source is a source of its
    own, null or empty text has size 1, a null id draws as the empty string, rows that repeat an id
    draw the same number. An empty table gives no rows. Columns named like the two new ones, in any case, are
    replaced; others may have any name, as a row travels as one value.
    """
    if weights and any(not math.isfinite(w) or w < 0 for w in weights.values()):
        raise ValueError("target weights must be finite and not negative")
    rates = checkpoint(source_rates(docs, weights, alpha, size_ratio, source_col, text_col))
    cols = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("mix_copy", "mix_key")]
    src = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("-"))
    rates = rates.select(
        F.coalesce(F.concat(F.lit("s"), F.col("_source")), F.lit("-")).alias("_source"), "_parts", "_cdf"
    )
    rows = docs.select(F.struct(*cols).alias("_row"), src.alias("_src"), F.col(id_col).alias("_id"))
    n = rates.count()
    if n <= BROADCAST_SOURCES:
        check_broadcast(n * (TERMS + 4), "source rates")
        joined = rows.join(F.broadcast(rates), F.col("_src") == F.col("_source"))
    else:
        salted = rates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int")
        joined = rows.withColumn("_s", salt).join(salted, (F.col("_src") == F.col("_source")) & (F.col("_s") == F.col("_salt")))
    draw = lambda i: F.size(F.filter("_cdf", lambda c: c <= uniform(seed, F.col("_id"), i)))
    copies = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), lambda acc, i: acc + draw(i))
    drawn = joined.withColumn("_n", copies).where("_n > 0")
    out = drawn.select("_row", "_id", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("mix_copy"))
    key = (uniform(seed + 1, F.col("_id"), F.col("mix_copy")) * float(1 << 52)).cast("long")
    return out.select("_row.*", "mix_copy", key.alias("mix_key")).repartition("mix_key").sortWithinPartitions("mix_key")
