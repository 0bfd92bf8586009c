"""A fresh folder that every executor can reach; shuffle files that go when their job ends."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """New folder below the cluster's shared checkpoint folder.

    A temporary folder of this machine is used only where Spark itself runs on
    this machine alone and names no shared folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a shared folder")
        shared = tempfile.mkdtemp(prefix="ledgerlake-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs in this block remove their shuffle files when they end.

    What is read afterwards is their result, so nothing could ask for the files again.
    Otherwise they stay on the executors' disks until the driver happens to collect
    garbage. An executor lost while a job runs is recovered as ever.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
