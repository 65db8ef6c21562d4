"""Materialised stages: a DataFrame written once as parquet in the shared
folder (``spark.checkpoint.dir``) and read back, so later consumers scan the
small stored result instead of re-running its lineage."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from audival.session import checkpoint_dir


class Stager:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        base = root or f"{checkpoint_dir(spark).rstrip('/')}/audival-stages/{uuid.uuid4().hex}"
        self.root = base.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Overwrite ``name`` with ``df`` and return a scan of what was written.
        Each stage has its own path, so no plan reads the path it replaces."""
        path = self.path(name)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)  # schema known: no footer read

    def discard(self) -> None:
        """Remove the folder and all stages in it."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def run_concurrently(jobs: dict[str, Callable[[], DataFrame]], workers: int = 4) -> dict[str, DataFrame]:
    """Run independent stage builds as concurrent Spark jobs (one driver
    thread each): small jobs then share the executors instead of queueing.
    The builds must not depend on each other."""
    if len(jobs) <= 1 or workers <= 1:
        return {name: build() for name, build in jobs.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(jobs))) as pool:
        futures = {name: pool.submit(build) for name, build in jobs.items()}
        return {name: f.result() for name, f in futures.items()}
