"""Numpy archives of trajectories and segmentation passes as rows.

Archives are read through Spark's binary reader and decoded one at a time as plain arrays; pickled objects are refused.
"""

from __future__ import annotations

import io
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_VEC = {"pos": "pxyz", "lin_vel": "vxyz", "ang_vel": "wxyz", "scale_mul": "sxyz", "colour": "crgb"}
TRAJ = "path string, frame int, body_id int, " + ", ".join(f"{v[0]}{a} double" for v in _VEC.values() for a in v[1:]) + ", qw double, qx double, qy double, qz double, present boolean, opacity double, radius double, mass double"
SEG = "path string, frame int, y int, x int, body_id int"


def arrays(content: bytes, skip: tuple[str, ...] = ()) -> dict[str, np.ndarray]:
    """Arrays of an archive by name; object arrays are refused unless they are skipped."""
    out = {}
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name in archive.namelist():
            key = name.removesuffix(".npy")
            if key not in skip:
                out[key] = np.lib.format.read_array(io.BytesIO(archive.read(name)), allow_pickle=False)
    return out


def _files(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", name).load(root).select("path", "content")


def trajectories(spark: SparkSession, root: str, name: str = "trajectory.npz") -> DataFrame:
    """``TRAJ`` rows of every archive: pos, lin_vel, ang_vel [T, B, 3], quat [T, B, 4] (w, x, y, z), body_ids, mass and
    radius [B], and optional present, scale_mul, colour, opacity, which default to true, 1, 0 and 1."""
    names = [c.split(" ")[0] for c in TRAJ.split(", ")]

    def decode(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a = arrays(content, skip=("body_names",))
                frames, bodies = a["pos"].shape[:2]
                cols = {"path": [path] * (frames * bodies), "frame": np.repeat(np.arange(frames, dtype=np.int32), bodies), "body_id": np.tile(a["body_ids"].astype(np.int32), frames)}
                shape = (frames, bodies, 3)
                for key, v in _VEC.items():
                    values = a.get(key, np.ones(shape) if key == "scale_mul" else np.zeros(shape)).astype(float).reshape(-1, 3)
                    cols |= {f"{v[0]}{axis}": values[:, i] for i, axis in enumerate(v[1:])}
                quat = a["quat"].astype(float).reshape(-1, 4)
                cols |= {f"q{axis}": quat[:, i] for i, axis in enumerate("wxyz")}
                cols["present"] = a.get("present", np.ones(shape[:2], bool)).astype(bool).ravel()
                cols["opacity"] = a.get("opacity", np.ones(shape[:2])).astype(float).ravel()
                cols |= {c: np.tile(a[c].astype(float), frames) for c in ("radius", "mass")}
                yield pa.RecordBatch.from_arrays([pa.array(cols[n]) for n in names], names)

    return _files(spark, root, name).mapInArrow(decode, TRAJ)


def segmentation(spark: SparkSession, root: str, name: str = "passes.npz", key: str = "segmentation") -> DataFrame:
    """``SEG`` rows of every foreground pixel of [T, H, W] or [T, H, W, 1] arrays."""

    def decode(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seg = arrays(content)[key]
                seg = seg[..., 0] if seg.ndim == 4 else seg
                f, y, x = np.nonzero(seg)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(f), pa.string()), *(pa.array(v.astype(np.int32)) for v in (f, y, x)), pa.array(seg[f, y, x].astype(np.int32))], ["path", "frame", "y", "x", "body_id"])

    return _files(spark, root, name).mapInArrow(decode, SEG)


def with_clip(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Rows keyed by the clip whose record lies in their folder."""
    return rows.withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).withColumn("folder", F.regexp_replace("folder", "^file:/+", "/")).join(records.select("clip_uid", F.regexp_replace("folder", "^file:/+", "/").alias("folder")), "folder").drop("folder", "path")
