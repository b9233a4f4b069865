"""Tables that cut lineage: Parquet in the shared folder of ``spark.checkpoint.dir``.

A written table survives the loss of any executor, is columnar and compressed, and is read back with an explicit
schema, so empty tables keep their columns.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Whether Spark deletes the shuffles of a query when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Lets Spark hold the large side of a join to a Bloom filter of the other side's keys before its shuffle, at any size.
SIFT = "spark.sql.optimizer.runtime.bloomFilter"
SIFTED = {f"{SIFT}.enabled": "true", f"{SIFT}.creationSideThreshold": "1g", f"{SIFT}.applicationSideScanSizeThreshold": "0"}


def with_row(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` beside all of ``docs`` as one struct ``row``, so that no name of a caller's column can meet one of ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)


def row_of(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of ``row`` again, with those in ``changed`` replaced."""
    return [changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in docs.columns]


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    Only a session whose executors run inside the driver, as in tests, may name none and gets a folder of the machine; a cluster must
    name one, as its executors do not share any folder that could be guessed.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if found.isDefined():
            folder = found.get()
        elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            folder = tempfile.mkdtemp(prefix="lawtrace-")
            spark.sparkContext.setCheckpointDir(folder)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/lawtrace-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, sifted: bool = False) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder; the table read back, and its path for ``dropped``. The shuffles that made it go at once.

    ``sifted``: rows of a large side that a join with a few keys, a stored table under a comparison, drops are not shuffled, as far as a Bloom
    filter of 8 MB at most tells them.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    own = {CLEANUP: "true", **(SIFTED if sifted else {})}
    was = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, *paths: str) -> None:
    """Delete tables of ``written`` that no later plan reads."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Stored tables of one step, deleted together by ``drop``. What a returned frame still reads must be in none that is
    dropped: those few tables stay until the session's shared folder is cleared."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, label: str, **how: bool) -> DataFrame:
        table, path = written(df, label, **how)
        self.paths.append(path)
        return table

    def drop(self) -> None:
        dropped(self.spark, *self.paths)
        self.paths = []
