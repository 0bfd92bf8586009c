"""The snapshot of the newest version of each key, carried forward by one load at a time.

The snapshot lies in buckets of its key, each a load of a table with a log. A new load touches
the buckets of its keys: these are merged and written anew, the others stay as they are, and
one commit makes all of them count. Trusted loads before are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.dedup import latest_load
from ledgerlake.sources.manifest import Version, committed, current, open_loads, write_loads

BUCKETS = 256
BUCKET = "_bucket"


def _stamp_of(version: Version) -> int:
    """The load that wrote a bucket is a part of the name of its folder."""
    return int(version.version.split("-")[0].removeprefix("load"))


class SnapshotStore:
    """Snapshot of one subject below `path`, by `keys`.

    The number of buckets belongs to the store: take about as many as the largest snapshot
    has gigabytes, so that a bucket is some files. A key with very many rows fills its
    bucket; it is written by several tasks.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str] | str, *, buckets: int = BUCKETS,
        null_keys: str = "drop",
    ):
        self.spark, self.path, self.buckets, self.null_keys = spark, path, buckets, null_keys
        self.keys = [keys] if isinstance(keys, str) else list(keys)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _before(self, dt_proc: str) -> dict[str, list[Version]]:
        """Buckets as the loads before `dt_proc` left them."""
        versions = committed(self.spark, self.path) or []
        return current(v for v in versions if _stamp_of(v) < int(dt_proc))

    def apply(self, rows: DataFrame, dt_proc: str) -> list[int]:
        """Merge the rows of one load into the snapshot; returns the buckets that were written.

        All rows of a key in the load replace what the snapshot has of that key. A load that is
        applied again replaces its first application, as long as nothing newer was applied.
        NULL keys are dropped, or with `null_keys="keep"` a key of their own.
        """
        done = [_stamp_of(v) for v in committed(self.spark, self.path) or []]
        if done and max(done) > int(dt_proc):
            raise ValueError(f"load {max(done)} was applied already, {dt_proc} is older")
        new = rows.drop("dt_proc").withColumn("dt_proc", F.lit(dt_proc))
        if self.null_keys == "drop":
            new = new.dropna("any", subset=self.keys)
        new = new.withColumn(BUCKET, self._bucket())
        before = self._before(dt_proc)
        # As many numbers as there are buckets at most.
        touched = {str(r[0]) for r in new.select(BUCKET).distinct().collect()}
        # Buckets that only the first application of this load had written go back to what they were.
        now = current(committed(self.spark, self.path) or [])
        touched |= {b for b, versions in now.items() if versions != before.get(b)}
        merged = new
        prior = {b: before[b] for b in touched if b in before}
        if prior:
            older = open_loads(self.spark, self.path, prior).withColumnRenamed("dt_proc", BUCKET)
            older = older.withColumnRenamed("_load", "dt_proc")
            both = older.select(*new.columns).unionByName(new)
            merged = latest_load(both, self.keys, null_keys=self.null_keys)
        stored = merged.withColumnRenamed("dt_proc", "_load").hint("rebalance", BUCKET)
        write_loads(stored, self.path, BUCKET, sorted(touched), version_prefix=f"load{dt_proc}-")
        return sorted(int(b) for b in touched)

    def rows(self) -> DataFrame:
        """Every row of the newest version of its key, with the load that brought it."""
        loads = current(committed(self.spark, self.path) or [])
        stored = open_loads(self.spark, self.path, loads).drop("dt_proc")
        return stored.withColumnRenamed("_load", "dt_proc")
