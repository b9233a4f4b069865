"""Annotations of pairs as tables: written whole, and replaced for chosen clips only.

``<path>/pixels`` has one folder for each annotation and side and ``<path>/timelines`` the gates of frames; both are cut into ``batches``
by clip, so that a later run rewrites only the batches of its clips.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtrace.operators import annotate

LAYOUT = {"pixels": ("annotation", "side", "batch"), "timelines": ("batch",)}


def _batch(batches: int):
    return F.pmod(F.xxhash64("clip_uid"), F.lit(batches)).cast("int")


def _written(rows: DataFrame, path: str, name: str) -> None:
    by = LAYOUT[name]
    # one task for each partition folder and range of clips would be many small files: rows of a folder meet by its columns and clip
    rows.repartition(*by, "clip_uid").sortWithinPartitions(*by, "clip_uid").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(f"{path}/{name}")


def _files(spark: SparkSession, path: str, name: str, touched: list[int]) -> dict[str, set[str]]:
    """Files of each partition folder of the touched batches."""
    jvm, out = spark.sparkContext._jvm, {}
    for b in touched:
        at = jvm.org.apache.hadoop.fs.Path("/".join([path, name, *[f"{c}=*" for c in LAYOUT[name][:-1]], f"batch={b}", "*.parquet"]))
        for found in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []:
            out.setdefault(found.getPath().getParent().toString(), set()).add(found.getPath().getName())
    return out


def annotate_release(cells: DataFrame, plans: DataFrame, motion_of: Callable[[DataFrame], DataFrame], path: str, height: int, width: int, batches: int = 64, energies: DataFrame | None = None) -> None:
    """Annotate all clips with a plan and write both tables; what other batches hold stays."""
    rows, times = annotate.annotate_pairs(cells, plans, motion_of(plans), height, width, energies)
    for name, table in (("pixels", rows), ("timelines", times)):
        _written(table.withColumn("batch", _batch(batches)), path, name)
    times.unpersist()


def reannotate(cells: DataFrame, plans: DataFrame, motion_of: Callable[[DataFrame], DataFrame], chosen: DataFrame, path: str, height: int, width: int, batches: int = 64, energies: DataFrame | None = None) -> None:
    """Annotate the clips of ``chosen`` (clip_uid) again and replace their rows; all other rows keep their values.

    Plans are filtered before cells or trajectories are read. Each touched batch is rewritten by one dynamic overwrite from its other
    clips' old rows and the new ones, so a repeated run changes nothing, and a batch is either old or new. Folders that
    would be empty now are removed. The numbers of the touched batches come to the driver, ``batches`` at most.
    """
    spark = cells.sparkSession
    own = plans.join(chosen.select("clip_uid").distinct(), "clip_uid", "left_semi")
    rows, times = annotate.annotate_pairs(cells.join(own.select("clip_uid"), "clip_uid", "left_semi"), own, motion_of(own), height, width, energies)
    touched = [r["batch"] for r in chosen.select(_batch(batches).alias("batch")).distinct().collect()]
    for name, table in (("pixels", rows), ("timelines", times)):
        before = _files(spark, path, name, touched)
        new = table.withColumn("batch", _batch(batches))
        old = spark.read.parquet(f"{path}/{name}").where(F.col("batch").isin(touched)).join(chosen.select("clip_uid").distinct(), "clip_uid", "left_anti")
        _written(new.unionByName(old.select(*new.columns)), path, name)
        after = _files(spark, path, name, touched)
        jvm = spark.sparkContext._jvm
        for folder in [f for f, held in before.items() if after.get(f) == held]:  # no row was written there
            at = jvm.org.apache.hadoop.fs.Path(folder)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    times.unpersist()
