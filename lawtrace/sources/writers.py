"""Writing a release: tables, split lists, the index with embedded videos, and tar shards."""

from __future__ import annotations

import io
import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtrace.operators.release import SPLITS


def write_table(rows: DataFrame, path: str, by: str = "scenario") -> None:
    """Parquet partitioned by a low-cardinality column."""
    rows.write.partitionBy(by).parquet(path)


def write_split_lists(index: DataFrame, out: str) -> None:
    """Sorted clip uids under ``out/<split>``, one folder of text for each split, empty if it has none.

    Range-sorted over as many files as the rows need; their names are in order."""
    for name, _ in SPLITS:
        own = index.where(F.col("split") == name).select("clip_uid")
        own.repartitionByRange("clip_uid").sortWithinPartitions("clip_uid").write.text(f"{out}/{name}")


def write_index(index: DataFrame, records: DataFrame, root: str, out: str) -> None:
    """The index with ``rgb`` (bytes, path) of every clip and ``overlay`` of debug clips; a video column without any
    video is left out. Paths are chosen by file name before contents are read."""
    spark = index.sparkSession

    def videos(name: str, clips: DataFrame) -> DataFrame:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"{name}.mp4").load(root)
        keyed = found.withColumn("folder", F.regexp_replace(F.regexp_replace("path", "/[^/]*$", ""), "^file:/+", "/"))
        own = records.select("clip_uid", F.regexp_replace("folder", "^file:/+", "/").alias("folder")).join(clips, "clip_uid", "left_semi")
        return keyed.join(own, "folder").select("clip_uid", F.struct(F.col("content").alias("bytes"), F.concat("clip_uid", F.lit(f"/{name}.mp4")).alias("path")).alias(name))

    rows = index
    for name, clips in (("rgb", index.select("clip_uid")), ("overlay", index.where("split = 'debug'").select("clip_uid"))):
        own = videos(name, clips)
        if not own.isEmpty():
            rows = rows.join(own, "clip_uid", "left")
    rows.write.parquet(out)


SHARD = "split string, shard string, part int, clips int, bytes long, tar binary"


def shards(records: DataFrame, splits: DataFrame, root: str, members: tuple[str, ...], most_bytes: int, suffix: str = "") -> DataFrame:
    """``SHARD`` rows, each one tar of whole clips in clip order: next fit, so a shard closes when the next clip would
    pass ``most_bytes``; a clip's key is its uid with ``/`` as ``__``; clips without any member are left out.

    Clips are range-sorted by (split, clip_uid) and every range packs its own shards, so no task holds a whole split and
    a lost task repeats only its range; a release of one range is packed exactly in sequence. A task holds one shard.
    """
    spark = records.sparkSession
    pattern = "{" + ",".join(members) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    files = files.select(F.regexp_replace(F.regexp_replace("path", "/[^/]*$", ""), "^file:/+", "/").alias("folder"), F.regexp_extract("path", "([^/]*)$", 1).alias("member"), "content")
    keyed = files.join(records.select("clip_uid", "pair_uid", F.regexp_replace("folder", "^file:/+", "/").alias("folder")), "folder").join(splits.select("pair_uid", "split"), "pair_uid")
    clips = keyed.groupBy("split", "clip_uid").agg(F.array_sort(F.collect_list(F.struct("member", "content"))).alias("files"))

    def packed(batches):
        from pyspark import TaskContext

        part, numbers = TaskContext.get().partitionId(), {}
        split, buffer, tar, size, n = None, None, None, 0, 0

        def closed():
            tar.close()
            k = numbers.get(split, 0)
            numbers[split] = k + 1
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in (split, f"{split}{suffix}-{part:05d}-{k:03d}.tar")] + [pa.array([part], pa.int32()), pa.array([n], pa.int32()), pa.array([size], pa.int64()), pa.array([buffer.getvalue()], pa.binary())], ["split", "shard", "part", "clips", "bytes", "tar"])

        for batch in batches:
            for row in batch.to_pylist():
                need = sum(len(f["content"]) for f in row["files"])
                if tar is not None and (row["split"] != split or (size and size + need > most_bytes)):
                    yield closed()
                    tar = None
                if tar is None:
                    split, buffer, size, n = row["split"], io.BytesIO(), 0, 0
                    tar = tarfile.open(fileobj=buffer, mode="w")
                for f in row["files"]:
                    info = tarfile.TarInfo(f"{row['clip_uid'].replace('/', '__')}.{f['member']}")
                    info.size = len(f["content"])
                    tar.addfile(info, io.BytesIO(f["content"]))
                size, n = size + need, n + 1
        if tar is not None:
            yield closed()

    return clips.repartitionByRange("split", "clip_uid").sortWithinPartitions("split", "clip_uid").mapInArrow(packed, SHARD)


def write_taxonomy(index: DataFrame, out: str) -> None:
    """What is in the release, as JSON: ``scenarios`` with their medium, occluder and capabilities, their clips and the families present, and
    ``families`` with their domain, law, kind, what they are scored on and need, their clips and scenarios. Only what the release holds."""
    from lawtrace.operators import taxonomy

    spark = index.sparkSession
    for name, own, other, known in (("scenario", "scenarios", "family", taxonomy.scenarios(spark).drop("scenario_no")), ("family", "families", "scenario", taxonomy.families(spark).drop("family_no"))):
        held = index.groupBy(name).agg(F.count("*").alias("clips_in_release"), F.array_sort(F.collect_set(other)).alias("families" if own == "scenarios" else "scenarios"))
        held.join(F.broadcast(known), name, "left").write.json(f"{out}/{own}")  # a few fixed rows


def export(spark: SparkSession, root: str, out: str, members: tuple[str, ...] = ("rgb.mp4", "meta.json"), most_bytes: int = 128 << 20) -> DataFrame:
    """Index, split lists, shards and taxonomy of the release tree; returns the counters by split. A task holds a shard as one value several times over, so
    ``most_bytes`` stays far below an executor's memory."""
    from lawtrace.operators import release
    from lawtrace.sources.records import clip_records

    records = clip_records(spark, root)
    assigned = release.splits(records)
    index = release.index_rows(records, assigned)
    write_index(index, records, root, f"{out}/index")
    write_split_lists(index, f"{out}/splits")
    shards(records, assigned, root, members, most_bytes).write.partitionBy("split").parquet(f"{out}/shards")
    write_taxonomy(index, f"{out}/taxonomy")
    return release.counters(index)
