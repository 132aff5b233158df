"""Relational patterns that document plans rest on, in a form that scales.

Ranges and nearest matches are turned into equal keys first; ordered first/last picks are
aggregates over structs, so that they combine on the map side; top-k uses ranks that the
engine limits per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The least row of each key by ``order``."""
    rest = [c for c in df.columns if c not in (*keys, *order)]
    return df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in (*order, *rest)])


def unique_lookup(facts: DataFrame, dims: DataFrame, key: str, value: str) -> DataFrame:
    """Facts with the dimension's value where exactly one row of the dimension has the key."""
    one = dims.groupBy(key).agg(F.count("*").alias("c"), F.min(value).alias(value)).where("c = 1").drop("c")
    return facts.join(one, key, "left")


def band_join(a: DataFrame, b: DataFrame, key: str, at_a: str, at_b: str, width: int) -> DataFrame:
    """Pairs of one key with ``|at_a - at_b| <= width``; the band becomes equal buckets."""
    size = max(1, width)
    bucket = lambda c: F.floor(F.col(c) / size).cast("bigint")
    left = a.withColumn("_bucket", F.explode(F.sequence(bucket(at_a) - 1, bucket(at_a) + 1)))
    return left.join(b.withColumn("_bucket", bucket(at_b)), [key, "_bucket"]).where(F.abs(F.col(at_a) - F.col(at_b)) <= width).drop("_bucket")


def as_of(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Each left row with the value of the latest right row of its key that is not later.

    One union and one window over key and time; no pair is built.
    """
    l = left.select("*", F.lit(1).alias("_side"), F.lit(None).cast(right.schema[value].dataType).alias(value))
    r = right.select(key, at, value, F.lit(0).alias("_side"))
    both = l.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last(value, ignorenulls=True).over(w)).where("_side = 1").drop("_side")


def sessions(df: DataFrame, key: str, at: str, gap: Column) -> DataFrame:
    """Rows with an island number: a new one wherever the step from the row before exceeds ``gap``."""
    w = Window.partitionBy(key).orderBy(at)
    step = F.col(at) - F.lag(at).over(w)
    return df.withColumn("island", F.sum(F.coalesce((step > gap).cast("int"), F.lit(0))).over(w))


def top_k(df: DataFrame, key: str, order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def rank_assign(free: DataFrame, pool: DataFrame, key: str, free_order: str, pool_order: str) -> DataFrame:
    """The k-th of the pool to the k-th free row of the same key."""
    rank = lambda o: F.row_number().over(Window.partitionBy(key).orderBy(o))
    return free.withColumn("_rank", rank(free_order)).join(pool.withColumn("_rank", rank(pool_order)), [key, "_rank"]).drop("_rank")


def within_budget(df: DataFrame, key: str, order: list[str], size: Column, budget: int) -> DataFrame:
    """Rows in order as long as the running size stays within the budget."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)


def compare(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """(key, diff): full outer comparison of two versions of a relation."""
    j = a.select(key, F.col(value).alias("va"), F.lit(1).alias("ia")).join(b.select(key, F.col(value).alias("vb"), F.lit(1).alias("ib")), key, "full_outer")
    diff = F.when(F.col("ia").isNull(), "added").when(F.col("ib").isNull(), "removed").when(F.col("va").eqNullSafe(F.col("vb")), "same").otherwise("changed")
    return j.select(key, diff.alias("diff"))
