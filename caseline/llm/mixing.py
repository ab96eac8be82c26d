"""Mixing sources to target weights by Poisson replication.

A source that should make up a share of the mixture has a mean repetition rate: its share of the rows
wanted over its rows. Every document draws a uniform number from a hash of seed and id, inverts the
Poisson distribution of its source's rate, is repeated that often, and all copies are put in the order
of another hash. Rows of a null or repeated id draw by their text too, and those that share both by their
place in the scan. All this is the same when a lost task runs again on the same files.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseline.llm.common import let, written
from caseline.operators.joins import bounded

SEED = 17
#: Bits of the hash that make the uniform number, few enough for an exact double.
BITS = 48
#: Poisson counts beyond this many standard deviations over the mean are below 2**-BITS.
TAIL = 12
#: Logarithms of factorials from here on come from Stirling's series, which is exact to a double there.
EXACT_FACTORIALS = 100


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from the first 48 bits of an MD5 over seed and parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("double") / F.lit(float(1 << BITS))


def log_factorial(k: Column) -> Column:
    k = k.cast("double")
    return (k + 0.5) * F.log(k) - k + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * k) - 1 / (360 * k * k * k)


def rates(docs: DataFrame, weights: Mapping[str, float], other: float, epochs: float, source: str) -> DataFrame:
    """Mean repetitions per source, and the distribution function of each as an array from ``__mix_first`` on.

    The array covers the counts that a draw can reach, so it grows with the root of the rate.
    ``weights`` are relative; sources that it lacks, null included, get ``other``.
    """
    counts = docs.groupBy(F.col(source).alias("__mix_source")).agg(F.count(F.lit(1)).alias("n"))
    weight = F.lit(float(other))
    for name, value in weights.items():
        weight = F.when(F.col("__mix_source") == name, F.lit(float(value))).otherwise(weight)
    counts = counts.withColumn("weight", weight)
    total = counts.agg(F.sum("weight").alias("w"), F.sum("n").alias("rows")).first()
    wanted = epochs * (total["rows"] or 0) / (total["w"] or 1.0)
    out = counts.withColumn("rate", F.col("weight") * F.lit(float(wanted)) / F.col("n"))
    reach = TAIL * F.sqrt("rate") + TAIL
    top = F.ceil(F.col("rate") + reach).cast("long")
    low = F.floor(F.col("rate") - reach).cast("long")
    out = out.withColumn("__mix_first", F.when(low >= EXACT_FACTORIALS, low).otherwise(F.lit(0).cast("long")))
    first = F.col("__mix_first")
    zero = F.struct(
        F.when(first > 0, log_factorial(first)).otherwise(F.lit(0.0)).alias("logs"),
        F.lit(0.0).alias("total"),
        F.array().cast("array<double>").alias("cdf"),
    )

    def step(acc: Column, k: Column) -> Column:
        logs = acc["logs"] + F.when(k > first, F.log(k.cast("double"))).otherwise(F.lit(0.0))
        total = acc["total"] + F.exp(k * F.log("rate") - F.col("rate") - logs)
        return F.struct(logs.alias("logs"), total.alias("total"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    running = F.aggregate(F.sequence(first, top), zero, step, lambda acc: acc["cdf"])
    return out.withColumn("__mix_cdf", F.when(F.col("rate") > 0, running).otherwise(F.array(F.lit(1.0))))


def mixed(
    docs: DataFrame,
    weights: Mapping[str, float],
    other: float = 1.0,
    epochs: float = 1.0,
    seed: int = SEED,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``docs`` with every row repeated a Poisson number of times, in a global random order.

    Adds ``replica`` (from 0) and ``shuffle_key``, which the rows are range-partitioned and sorted by.
    ``epochs`` times the rows of ``docs`` are expected in all, each source with its share of the
    weights. A weight of 0 drops a source. Null sources count as one source. A row whose key no other
    has draws by its key; rows of a null or repeated key draw by key and text, and rows that are equal in
    both by their place in the scan too, so that each draws for itself and a hot group of them spreads over
    the global order. These alone differ if the same rows come in other files. A table without the text
    column has key and place. Null texts are rows like others. Columns of ``docs`` named like a result are
    replaced. An empty table gives an empty result.
    """
    table = bounded(rates(docs, weights, other, epochs, source).select("__mix_source", "__mix_first", "__mix_cdf"))
    docs = docs.drop("replica", "shuffle_key")
    texts = [F.col(text)] if text in docs.columns else []
    # 128 bits of the text, so that no whole text is shuffled to find equal rows
    docs = docs.withColumn("__mix_print", F.md5(texts[0]) if texts else F.lit(None).cast("string"))
    keys = docs.groupBy(F.col(key).alias("__mix_key")).agg(F.count(F.lit(1)).alias("__mix_rows"))
    keys = written(keys.where("__mix_rows > 1").select("__mix_key"), "mix-keys")
    repeated = bounded(keys.where("__mix_key IS NOT NULL"))
    alike = F.xxhash64(F.col(key).isNull(), F.col(key), "__mix_print")
    shared = docs.select(key, "__mix_print").join(bounded(keys), F.col(key).eqNullSafe(F.col("__mix_key")), "left_semi")
    equal = shared.groupBy(alike.alias("__mix_alike")).agg(F.count(F.lit(1)).alias("__mix_rows"))
    # keys that are all different need no second look at the texts
    equal = written((equal.limit(0) if keys.isEmpty() else equal.where("__mix_rows > 1")).select("__mix_alike"), "mix-alike")
    held = docs.withColumn("__mix_at", F.monotonically_increasing_id())
    held = held.join(table, F.col(source).eqNullSafe(F.col("__mix_source")))
    held = held.join(repeated, F.col(key) == F.col("__mix_key"), "left")
    held = held.join(bounded(equal), alike == F.col("__mix_alike"), "left")
    alone = F.col(key).isNotNull() & F.col("__mix_key").isNull()
    at = F.when(F.col("__mix_alike").isNotNull(), F.col("__mix_at"))
    draw = (
        F.when(alone, uniform(seed, F.col(key)))
        .when(at.isNull(), uniform(seed, F.col(key), *texts))
        .otherwise(uniform(seed, F.col(key), *texts, at))
    )
    # the count is the number of distribution values at or below the draw
    below = let(draw, lambda u: F.size(F.filter("__mix_cdf", lambda c: c <= u)))
    counted = held.withColumn("__mix_count", F.col("__mix_first") + below)
    copies = counted.where(F.col("__mix_count") > 0).withColumn(
        "replica", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__mix_count") - 1))
    )
    # a null place leaves the hash as it is
    placed = copies.withColumn("shuffle_key", F.xxhash64(F.lit(seed), F.col(key), *texts, at, F.col("replica")))
    return placed.drop(*[c for c in placed.columns if c.startswith("__mix_")]).orderBy("shuffle_key", "replica")
