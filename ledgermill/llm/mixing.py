"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate. The number of copies of a document is
the inverse of the Poisson distribution with that mean at a uniform number
hashed from the seed and the document's key, so a recomputed task makes the same
copies. Copies are exploded and dealt to all partitions by a hash of key and
copy, then ordered by it inside each: a global shuffle.

Rates come from one grouped sum of bytes per source; the table of sources is
broadcast while it is small (measured) and otherwise joined with salted hot
sources. A null source is a source of its own. A null key hashes like the word
null; rows of equal key get equal numbers of copies. A source without a byte of
text keeps rate 1. Empty tables give empty results. Other columns are kept; the
copy number's column gets underscores added until its name is free.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.scale import attach, stage

MEAN_LIMIT = 500.0  # larger means are sums of independent parts below this, as exp(-mean) must not vanish


def free_name(name: str, taken: list[str]) -> str:
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def rates_by_power(
    docs: DataFrame, power: float, size: float = 1.0, source: str = "source", text: str = "text"
) -> DataFrame:
    """source, rate: sources weigh as their bytes to `power`, and all copies together
    have about `size` times the bytes of `docs`. Power 1 keeps the proportions, 0 makes sources equal."""
    sizes = stage(
        docs.groupBy(F.col(source).alias("source")).agg(
            F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("double").alias("bytes")
        ),
        "mix-sizes",
    )
    weight = F.when(F.col("bytes") > 0, F.pow("bytes", F.lit(power))).otherwise(0.0)
    total = sizes.agg(F.sum("bytes").alias("bytes")).scalar()
    weights = sizes.agg(F.sum(weight).alias("weight")).scalar()
    rate = F.lit(size) * total * weight / weights / F.col("bytes")
    return sizes.select("source", F.when(F.col("bytes") > 0, rate).otherwise(1.0).alias("rate"))


def rates_by_weight(docs: DataFrame, targets: DataFrame, source: str = "source", text: str = "text") -> DataFrame:
    """source, rate: the rates at which sources reach the shares `targets` (source, weight), at the size
    of `docs`. Sources without a target get rate 0."""
    sizes = stage(
        docs.groupBy(F.col(source).alias("source")).agg(
            F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("double").alias("bytes")
        ),
        "mix-sizes",
    )
    joined = sizes.join(targets.select("source", "weight"), "source", "left").fillna(0.0, ["weight"])
    joined = stage(joined, "mix-weights")
    total = joined.agg(F.sum("bytes").alias("bytes")).scalar()
    weights = joined.filter("bytes > 0").agg(F.sum("weight").alias("weight")).scalar()
    rate = total * F.col("weight") / weights / F.col("bytes")
    return joined.select("source", F.when(F.col("bytes") > 0, rate).otherwise(1.0).alias("rate"))


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits, a function of the seed and the parts."""
    words = [F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    digest = F.md5(F.concat_ws("|", F.lit(seed), *words))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def poisson_steps(mean: Column) -> Column:
    """The distribution function of a Poisson variable at 0, 1, 2, ..., as far as `uniform` can reach."""
    last = (mean + 12 * F.sqrt(mean) + 40).cast("int")
    none = F.exp(-mean)
    walked = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(none.alias("p"), F.array(none).alias("steps")),
        lambda at, k: F.struct(
            (at["p"] * mean / k).alias("p"),
            F.concat(at["steps"], F.array(F.element_at(at["steps"], -1) + at["p"] * mean / k)).alias("steps"),
        ),
    )
    return walked["steps"]


def replicate(
    docs: DataFrame, rates: DataFrame, seed: str = "mix", source: str = "source", key: str = "doc_id"
) -> tuple[DataFrame, str]:
    """`docs` with every row once per copy, globally shuffled, and the name of the copy number's column (from 1)."""
    copy = free_name("copy", docs.columns)
    name, steps, parts, order = (free_name(n, docs.columns) for n in ("_source", "_steps", "_parts", "_order"))
    share = F.col("rate") / F.col(parts)
    table = rates.withColumn(parts, F.greatest(F.lit(1), F.ceil(F.col("rate") / MEAN_LIMIT)).cast("int")).select(
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")).alias(name), parts, poisson_steps(share).alias(steps)
    )
    named = docs.withColumn(name, F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null")))
    joined = attach(named, stage(table, "mix-rates"), [name], how="inner", spread=[F.col(key)])
    number = F.aggregate(
        F.sequence(F.lit(1), F.col(parts)),
        F.lit(0),
        lambda total, part: total
        + F.size(F.filter(F.col(steps), lambda s: s <= uniform(seed, part, F.col(key)))),
    )
    copies = joined.withColumn(copy, number).filter(F.col(copy) > 0).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(copy)))
    )
    mixed = copies.withColumn(order, F.xxhash64(F.lit(seed), F.col(key), F.col(copy)))
    return mixed.repartition(order).sortWithinPartitions(order).select(*docs.columns, copy), copy


def poisson_mix(
    docs: DataFrame, power: float = 0.7, seed: str = "mix", source: str = "source", key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` replicated so that sources weigh as their bytes to `power`, with the copy number."""
    return replicate(docs, rates_by_power(docs, power, 1.0, source, text), seed, source, key)[0]
