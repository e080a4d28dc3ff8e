"""Stored versions of a table with a digest per bucket of keys, so that two versions are compared without reading both.

``path/rows/_bucket=B`` holds the rows whose key hash is B modulo the number of buckets,
a power of two that follows the number of rows; ``path/digests`` holds for each bucket
the number of its rows and two sums of their hashes, which do not depend on the order;
``path/layout`` has the columns alone.
Buckets of a larger version fold onto those of a smaller one by the same modulus, and
their digests add up.  Only buckets whose digests differ are read and joined.

A null differs from every value and equals a null; rows of one key are compared with
each other; rows with a null key are all in one bucket and never meet (added, removed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.operators.audit import version_diff

BUCKET_ROWS = 500_000
MAX_BUCKETS = 1 << 16  # so many digests at most are looked at by the driver
_SUMS = ("n", "first", "second")


def _hash(columns: list[str], seed: int) -> Column:
    """Of the values and of which of them are null; a plain row hash skips nulls."""
    marks = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(seed), *marks).cast("decimal(20,0)")


def write_version(rows: DataFrame, path: str, key: str, compared: list[str], buckets: int | None = None) -> None:
    """Write the key and the compared columns; ``buckets`` must be a power of two."""
    if buckets is None:
        wanted = max(1, -(-rows.count() // BUCKET_ROWS))
        buckets = min(MAX_BUCKETS, 1 << (wanted - 1).bit_length())
    if buckets & (buckets - 1) or not 0 < buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be a power of two up to {MAX_BUCKETS}")
    placed = rows.select(key, *compared).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    placed.repartition("_bucket").write.partitionBy("_bucket").mode("overwrite").parquet(f"{path}/rows")
    stored = rows.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    own = [key, *compared]
    digests = stored.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum(_hash(own, 1)).alias("first"), F.sum(_hash(own, 2)).alias("second")
    )
    rows.select(key, *compared).limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")
    digests.withColumn("buckets", F.lit(buckets)).coalesce(1).write.mode("overwrite").parquet(f"{path}/digests")


def unequal(spark: SparkSession, before: str, after: str) -> tuple[DataFrame, DataFrame]:
    """The rows of both versions in the buckets whose digests differ; no other file is read."""
    digests = [spark.read.parquet(f"{p}/digests") for p in (before, after)]
    sizes = [d.agg(F.max("buckets")).first()[0] for d in digests]
    shared = min([s for s in sizes if s], default=1)
    folded = [
        d.groupBy(F.pmod("_bucket", F.lit(shared)).alias("b")).agg(F.struct(*[F.sum(c).alias(c) for c in _SUMS]).alias(name))
        for d, name in zip(digests, ("old", "new"))
    ]
    differ = {r["b"] for r in folded[0].join(folded[1], "b", "full").where(~F.col("old").eqNullSafe(F.col("new"))).select("b").collect()}
    return tuple(
        _rows(spark, path).where(F.col("_bucket").isin([b for b in range(size or 0) if b % shared in differ])).drop("_bucket")
        for path, size in zip((before, after), sizes)
    )


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; a version without rows has its columns too."""
    layout = spark.read.parquet(f"{path}/layout").schema
    return spark.read.schema(layout.add("_bucket", "integer")).parquet(f"{path}/rows")


def changes(spark: SparkSession, before: str, after: str, key: str, compared: list[str]) -> DataFrame:
    """(key, change) of the rows that were added, removed or changed."""
    old, new = unequal(spark, before, after)
    return version_diff(old, new, key, compared).where("change <> 'same'")
