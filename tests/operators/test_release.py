"""Splits, validation, archives and shards on a synthetic release tree."""

import io
import json
import tarfile

import numpy as np
import pytest

from lawtrace.operators import release, taxonomy, validation
from lawtrace.sources import archives, records, writers


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("release")
    for i in range(12):
        for label in ("valid", "invalid"):
            folder = root / "clips" / f"drop_{i:04d}_{label}"
            folder.mkdir(parents=True)
            violation = {"t_event_frame": 3, "t_observable_frame": 4, "t_end_frame": 9, "violation_windows": [{"s": 3, "e": 9}], "intervention_windows": [{"s": 3, "e": 5}], "causal_body_ids": [2], "spatial_extent": "local", "intervention": {"severity_bin": "strong", "magnitude": 9.0}, "peak_residual": {"score": 0.9}}
            meta = {
                "clip_uid": f"rel/drop/{i:04d}/{label}", "pair_uid": f"rel/drop/{i:04d}", "twin_uid": f"rel/drop/{i:04d}/valid", "label": label, "scenario": "drop", "family": "continuity", "domain": "kinematics", "physics_medium": "rigid", "seed": i, "tier": "debug", "num_frames": 25, "fps": 12, "camera": {"motion": "static"},
                "instances": [{"body_id": 1, "role": "floor", "dormant": False}, {"body_id": 2, "role": "actor", "category": "sphere", "material": "wood", "mass_kg": 1.0, "dormant": False}], "assets": [{"license": "CC0"}], "prefix_identical": True, "energy_total": 5.0, "energy_anomaly": 0.0, "violation": violation if label == "invalid" else None,
            }
            (folder / "meta.json").write_text(json.dumps(meta))
            (folder / "rgb.mp4").write_bytes(bytes([i]) * 64)
            t = {"pos": np.arange(18, dtype=np.float32).reshape(3, 2, 3), "quat": np.tile(np.float32([1, 0, 0, 0]), (3, 2, 1)), "lin_vel": np.zeros((3, 2, 3), np.float32), "ang_vel": np.zeros((3, 2, 3), np.float32), "body_ids": np.int32([1, 2]), "mass": np.ones(2), "radius": np.full(2, 0.5), "body_names": np.array(["floor", "ball"], dtype=object)}
            np.savez(folder / "trajectory.npz", **t)
            s = np.zeros((3, 4, 4, 1), np.uint16)
            s[1, 2, 3] = 2
            np.savez(folder / "passes.npz", segmentation=s)
    return root


def test_splits_keep_their_shares_and_pairs(spark):
    pairs = spark.createDataFrame([(f"rel/{s}/{i:04d}",) for s, n in (("a", 100), ("b", 13), ("c", 2), ("d", 3)) for i in range(n)], "pair_uid string")
    rows = release.splits(pairs).collect()
    count = {}
    for r in rows:
        count[r.stratum, r.split] = count.get((r.stratum, r.split), 0) + 1
    assert {k[1]: v for k, v in count.items() if k[0] == "a"} == {"main": 75, "held_out": 20, "debug": 5}
    assert {k[1]: v for k, v in count.items() if k[0] == "b"} == {"main": 9, "held_out": 3, "debug": 1}
    assert {k[1]: v for k, v in count.items() if k[0] == "c"} == {"debug": 2}
    assert {k[1]: v for k, v in count.items() if k[0] == "d"} == {"main": 1, "held_out": 1, "debug": 1}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, release.splits(pairs.repartition(5)).collect()))


def test_records_are_valid_and_rules_find_faults(spark, tree):
    found = records.clip_records(spark, str(tree))
    assert found.count() == 24
    assert validation.violations(found).isEmpty()
    assert release.pair_integrity(found).isEmpty()
    assert validation.dangling_twins(found).isEmpty()
    broken = found.withColumn("domain", __import__("pyspark").sql.functions.lit("identity"))
    assert {r.rule for r in validation.violations(broken).collect()} == {"domain differs"}


def test_archives(spark, tree):
    rows = archives.with_clip(archives.trajectories(spark, str(tree)), records.clip_records(spark, str(tree)))
    assert rows.count() == 24 * 6
    r = rows.where("clip_uid = 'rel/drop/0003/valid' and frame = 2 and body_id = 2").first()
    assert (r.px, r.py, r.pz, r.qw, r.sx, r.opacity, r.present) == (15.0, 16.0, 17.0, 1.0, 1.0, 1.0, True)
    px = archives.segmentation(spark, str(tree))
    assert {(r.frame, r.y, r.x, r.body_id) for r in px.collect()} == {(1, 2, 3, 2)} and px.count() == 24
    bad = io.BytesIO()
    np.savez(bad, pos=np.array([{}], dtype=object))
    with pytest.raises(ValueError):
        archives.arrays(bad.getvalue())


def test_export(spark, tree, tmp_path):
    counts = {r.split: (r.clips, r.pairs) for r in writers.export(spark, str(tree), str(tmp_path / "out"), most_bytes=3000).collect()}
    assert counts == {"main": (18, 9), "held_out": (4, 2), "debug": (2, 1)}
    index = spark.read.parquet(str(tmp_path / "out/index"))
    assert index.count() == 24 and "overlay" not in index.columns and index.where("rgb.bytes is not null").count() == 24
    listed = [r.value for r in spark.read.text(str(tmp_path / "out/splits/main")).collect()]
    assert sorted(listed) == sorted(r.clip_uid for r in index.where("split = 'main'").collect())
    seen = {}
    for r in spark.read.parquet(str(tmp_path / "out/shards")).collect():
        names = tarfile.open(fileobj=io.BytesIO(r.tar)).getnames()
        assert r.bytes <= 3000 or r.clips == 1
        for n in names:
            seen.setdefault(n.split(".")[0], set()).add((r.split, r.shard))
    assert len(seen) == 24 and all(len(v) == 1 for v in seen.values())


def test_taxonomy(spark):
    cells = [r.cell for r in taxonomy.matrix(spark).collect()]
    assert (cells.count("build"), cells.count("defer")) == (166, 30)
    assert taxonomy.inconsistencies(spark).isEmpty()
    assert taxonomy.priced(taxonomy.matrix(spark), 3, 3, "release-solid", 4).first().hours == pytest.approx(108.5, abs=0.1)
