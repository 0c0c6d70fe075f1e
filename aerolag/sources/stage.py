"""Materialisation: stage tables on shared storage, and scoped caching."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from aerolag.session import stage_root


def stage_table(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage, survives the loss of any executor, and fixes the outcome of
    range-partitioned sorts, so that several readers see the same rows.
    """
    return Stages(df.sparkSession).put(df, label)


class Stages:
    """Stage tables of one job.

    ``put`` writes a table and reads it back, ``drop`` deletes one that nothing
    reads any more, and leaving a ``with`` block deletes all but those kept.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def _path(self, label: str) -> str:
        return f"{stage_root(self.spark)}/{self.spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, label: str = "stage") -> DataFrame:
        path = self._path(label)
        df.write.mode("errorifexists").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def put_bucketed(self, df: DataFrame, by: str, buckets: int, label: str = "stage") -> DataFrame:
        """Like ``put``, in buckets of the column ``by``: later windows and joins on it need no shuffle.

        Buckets are kept by the catalog only, so the table has an entry there
        for as long as it takes to resolve it.
        """
        path, name = self._path(label), f"stage_{uuid.uuid4().hex}"
        df.write.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(name)
        out = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay, as for any table with a path of its own
        self.paths[id(out)] = (out, path)
        return out

    def keep(self, df: DataFrame) -> DataFrame:
        """Leave ``df`` for readers after the block."""
        del self.paths[id(df)]
        return df

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            _, path = self.paths.pop(id(df))
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *failure: object) -> None:
        self.drop(*[df for df, _ in self.paths.values()])


@contextmanager
def held(*frames: DataFrame) -> Iterator[None]:
    """Keep frames in memory, spilling to disk, for the length of a block.

    Lost blocks are recomputed from lineage; nothing depends on them.
    """
    for frame in frames:
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield
    finally:
        for frame in frames:
            frame.unpersist()
