"""Kept rows of earlier runs, stored under each of their keys.

A row is stored once per band of its perceptual hash and once under its digest, with
all that a comparison needs.  The folder is ``run=NAME/slot=K``: every run writes its
own part, so a repeated run or batch replaces itself and no reader ever sees half of
two layouts; a slot holds the keys of one hash value.  A lookup names the slots that
the new rows' keys fall in and reads those only; nothing stored is cut into bands again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge import domains as D
from stepforge.operators import dedup
from stepforge.storage import exists

SLOTS = 256
ROW = ("id", "ord", "sha", "phash", "action", "words", "coordinates")


def slot_of(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


class StoredIndex:
    """The index below ``path`` as run ``run`` sees it: everything but its own earlier attempt."""

    def __init__(self, spark: SparkSession, path: str, run: str, distance: int = D.NEAR_DISTANCE, slots: int = SLOTS):
        self.spark, self.run, self.distance, self.slots = spark, run, distance, slots
        self.path = f"{path}/bands={distance + 1}-{slots}"

    def _stored(self) -> DataFrame | None:
        """All runs' entries; run and slot come from the folders, as text and number."""
        if not exists(self.spark, self.path):
            return None
        table = self.spark.read.parquet(self.path)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema.fields if f.name not in ("run", "slot"))
        return self.spark.read.schema(f"{fields}, run string, slot int").parquet(self.path).where(F.col("run") != self.run)

    def rows(self) -> DataFrame | None:
        """Each kept row once."""
        stored = self._stored()
        return None if stored is None else stored.where("home").select("run", *ROW)

    def hit_slots(self, keys: DataFrame) -> list[int]:
        """At most ``slots`` numbers."""
        return sorted(r[0] for r in keys.select(slot_of(F.col("key"), self.slots).alias("slot")).distinct().collect())

    def lookup(self, keys: DataFrame) -> DataFrame | None:
        """(key, band, ``ROW``) of the entries under the given keys."""
        stored = self._stored()
        if stored is None:
            return None
        near = stored.where(F.col("slot").isin(self.hit_slots(keys)))
        return near.join(keys.select("key").distinct(), "key", "left_semi").select("key", "band", *ROW)

    def add(self, kept: DataFrame) -> None:
        """Write the kept rows of this run; rows that an earlier run has stored are left out."""
        rows = dedup.index_rows(kept).select(*ROW)
        keyed = dedup.coarse_keys(dedup.prepare(rows), self.distance).drop("w", "bits")
        known = self.lookup(keyed)
        if known is not None:
            keyed = keyed.join(known.select("id").distinct(), "id", "left_anti")
        # the first band, or the digest of a row without a hash, stands for the row
        home = F.when(F.col("phash").isNull(), F.col("band").isNull()).otherwise(F.coalesce(F.col("band") == 0, F.lit(False)))
        entries = keyed.withColumn("home", home).withColumn("slot", slot_of(F.col("key"), self.slots))
        entries.hint("rebalance", "slot").write.mode("overwrite").partitionBy("slot").parquet(f"{self.path}/run={self.run}")

    def adopt(self, index: DataFrame) -> None:
        """Take over rows of an older, flat index, once."""
        if not exists(self.spark, self.path):
            StoredIndex.add(self._as("adopted"), dedup.migrate_index(index))

    def _as(self, run: str) -> "StoredIndex":
        other = StoredIndex.__new__(StoredIndex)
        other.__dict__.update(self.__dict__, run=run)
        return other
