"""Files that do not conform, scenes, plain tables, gaps of a lattice and recoloured bodies."""

import json

import numpy as np
from pyspark.sql import functions as F

from lawtrace.operators import materials, release
from lawtrace.sources import records, writers

GOOD = {"clip_uid": "r/a/0001/valid", "pair_uid": "r/a/0001", "label": "valid", "scenario": "drop", "family": "permanence", "domain": "identity", "physics_medium": "rigid", "seed": 1, "num_frames": 25, "fps": 12, "prefix_identical": True, "extra": {"is": "allowed"}}
VIOLATION = {"t_event_frame": 3, "t_observable_frame": 3, "t_end_frame": 9, "violation_windows": [{"s": 3, "e": 9}], "causal_body_ids": [1], "spatial_extent": "local"}


def planted(root, **files):
    for name, content in files.items():
        folder = root / name
        folder.mkdir(parents=True)
        (folder / "meta.json").write_text(content if isinstance(content, str) else json.dumps(content))


def test_conformance(spark, tmp_path):
    planted(
        tmp_path, good=GOOD, bad_text='{"clip_uid": "x", ', bad_type={**GOOD, "seed": "seven"}, no_seed={k: v for k, v in GOOD.items() if k not in ("seed", "label")}, null={**GOOD, "fps": None},
        violated={**GOOD, "label": "invalid", "violation": VIOLATION}, half={**GOOD, "label": "invalid", "violation": {k: v for k, v in VIOLATION.items() if k != "t_end_frame"}},
    )
    found = sorted((r["path"].rsplit("/", 2)[-2], r["rule"], r["field"]) for r in records.conformance(spark, str(tmp_path)).collect() if r["field"]) + sorted((r["path"].rsplit("/", 2)[-2], r["rule"]) for r in records.conformance(spark, str(tmp_path)).collect() if not r["field"])
    assert found == [("half", "field missing", "violation.t_end_frame"), ("no_seed", "field missing", "label"), ("no_seed", "field missing", "seed"), ("null", "field missing", "fps"), ("bad_text", "not of the schema"), ("bad_type", "not of the schema")]


def test_scenes_and_plain_tables(spark, tmp_path):
    scene = {"scenario": "drop", "seed": 4, "variant": 2, "gravity": [0, 0, -9.81], "floor_level": 0.0, "camera": {"motion": "orbit", "position": [1, 2, 3], "look_at": [0, 0, 0], "end_position": [3, 2, 1]}, "occluded_frames": [4, 5], "bodies": [{"segmentation_id": 3, "name": "ball", "kind": "sphere", "static": False, "position": [0, 0, 1]}]}
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "scene.json").write_text(json.dumps(scene))
    got = records.scenes(spark, str(tmp_path / "w")).first()
    assert (got["scenario"], got["camera"]["end_position"], got["bodies"][0]["segmentation_id"], got["bodies"][0]["role"]) == ("drop", [3.0, 2.0, 1.0], 3, None)
    rows = spark.createDataFrame([("drop", 1, [1.5, None]), ("toss", 2, []), ("drop", 3, None)], "scenario string, n int, xs array<double>")
    writers.write_table(rows, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(map(str, back.select("scenario", "n", "xs").collect())) == sorted(map(str, rows.collect()))
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["scenario=drop", "scenario=toss"]


def test_gaps_of_a_lattice(spark):
    planned = spark.createDataFrame([("drop", "a"), ("drop", "b"), ("toss", "a")], "scenario string, family string")
    made = spark.createDataFrame([("drop", "a", "old", 1), ("drop", "a", "new", 2), ("toss", "b", "unplanned", 3)], "scenario string, family string, clip_uid string, n int")
    wide = {r["scenario"]: (r["a"], r["b"], r["built"], r["total"]) for r in release.coverage(made, "scenario", "family", "clip_uid", "n", ["a", "b"], planned).collect()}
    assert wide == {"drop": ("new", None, 1, 2), "toss": (None, None, 0, 1)}
    gaps = release.missing(planned, made.select("scenario", "family"), ["scenario", "family"]).collect()
    assert sorted(map(tuple, gaps)) == [("drop", "b"), ("toss", "a")]


def test_recoloured_bodies_are_as_far_as_wanted(spark):
    rng = np.random.default_rng(7)
    colours = [tuple(map(float, c)) for c in rng.random((60, 3))] + [(0.5, 0.5, 0.5), (0.0, 0.0, 0.0), (1.0, 1.0, 1.0)] * 2
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(colours)], "n int, cr double, cg double, cb double")
    found = materials.recolour_targets(rows, 0.25).orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(len(colours)))
    for r in found:
        lab = [materials._lab(np.array([r[f"{p}{c}"] for c in "rgb"])) for p in "ct"]
        assert abs(np.linalg.norm(lab[0] - lab[1]) / 100 - 0.25) < 1e-3


def test_label_table(spark):
    rows = spark.createDataFrame([(1, 2, "ball", "CC0"), (1, 1, "floor", None), (2, 5, "cube", "CC0"), (2, 6, "cone", "CC0")], "scene int, body_id long, name string, license string")
    got = {r["scene"]: (r["names"], r["licences"], r["bodies"]) for r in release.label_table(rows, "scene").collect()}
    assert got == {1: ({0: "background", 1: "floor", 2: "ball"}, {"": 1, "CC0": 1}, 2), 2: ({0: "background", 5: "cube", 6: "cone"}, {"CC0": 2}, 2)}
    assert release.label_table(rows.where(F.lit(False)), "scene").collect() == []
