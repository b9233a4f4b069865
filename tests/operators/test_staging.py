"""Cases of staging that the tables do not show: rays along axes, shut boxes, tied supports, cameras that turn, and contacts that never close."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lawtrace.operators import staging, taxonomy, twins

BODIES = "clip_uid long, body_id long, ord int, static boolean, floor boolean, dormant boolean, box boolean, x0 double, y0 double, z0 double, hx double, hy double, hz double, q0 double, radius double"
TRAJ = "clip_uid long, body_id long, frame int, px double, py double, pz double, vx double, vy double, vz double, radius double, mass double"


def body(i, static=False, floor=False, dormant=False, box=False, at=(0, 0, 0), half=(1, 1, 1), q0=1.0, clip=1):
    return (clip, i, i, static, floor, dormant, box, *map(float, at), *map(float, half), q0, 0.5)


def row(i, frame, at, v=(0, 0, 0), clip=1, radius=0.5, mass=1.0):
    return (clip, i, frame, *map(float, at), *map(float, v), radius, mass)


def crosses(eye, point, box):
    """By steps along the line: dense enough for the cases below."""
    steps = 4000
    return any(all(abs(e + (p - e) * k / steps - c) <= h + 1e-9 for e, p, c, h in zip(eye, point, box[:3], box[3:])) for k in range(steps + 1))


def test_hidden_behind_boxes(spark):
    rng = random.Random(3)
    boxes = [body(1, True, box=True, at=(0, 5, 1), half=(1, 0.2, 2)), body(2, True, box=True, at=(3, 5, 1), half=(1, 0.5, 0.4)), body(3, True, box=True, at=(-4, 5, 1), half=(1, 0.2, 2), q0=0.9), body(4, True, True, box=True, at=(0, 5, -1), half=(9, 9, 20)), body(5, False, box=True, at=(5, 5, 0), half=(1, 1, 3)), body(6, True, at=(7, 5, 0), half=(1, 1, 3))]
    points = [(0.0, 10.0, 1.0), (0.0, 3.0, 1.0), (0.0, 5.0, 1.0), (0.0, 0.0, 1.0), (3.0, 10.0, 1.0), (-4.0, 10.0, 1.0), (0.5, 9.0, 3.5), (1.5, 9.0, 1.0)] + [(rng.uniform(-3, 3), rng.uniform(1, 12), rng.uniform(-1, 4)) for _ in range(60)]
    eye = (0.0, 0.0, 1.0)
    t = spark.createDataFrame([(1, i, *p) for i, p in enumerate(points)] + [(2, 0, 0.0, 10.0, 1.0)], "clip_uid long, n int, px double, py double, pz double")
    got = {(r["clip_uid"], r["n"]): r["hidden"] for r in staging.hidden_behind(t, spark.createDataFrame(boxes, BODIES), tuple(map(F.lit, eye))).collect()}
    assert got == {(1, i): p != eye and crosses(eye, p, (0, 5, 1, 1, 0.2, 2)) for i, p in enumerate(points)} | {(2, 0): False}


def test_points_on_the_face_of_a_box_are_hidden(spark):
    """Each point lies on the face of its own box that looks at the eye: the line meets the box at its end, whatever its length."""
    rng = random.Random(5)
    eye = (5.0, -20.0, 6.0)
    points = [(i, float(rng.randint(-40, 40)), float(rng.randint(-9, 40)), rng.randint(-40, 40) + 0.25) for i in range(300)]
    boxes = [body(1, True, box=True, at=(x, y + 0.5, z), half=(0.25, 0.5, 1.0), clip=i) for i, x, y, z in points]
    t = spark.createDataFrame(points, "clip_uid long, px double, py double, pz double")
    found = staging.hidden_behind(t, spark.createDataFrame(boxes, BODIES), tuple(map(F.lit, eye)))
    assert found.where("hidden").count() == len(points)


def test_support_ties_and_dormant_bodies(spark):
    bodies = [body(0, True, True, box=True, at=(0, 0, 0), half=(10, 10, 0.1)), body(1, at=(0, 0, 3)), body(2), body(3, dormant=True), body(4, True, box=True, at=(5, 5, 1), half=(1, 1, 1)), body(5)]
    traj = [row(1, f, (0, 0, 3)) for f in (0, 1)] + [row(2, 0, (9, 0, 1)), row(2, 1, (9, 0, 5)), row(3, 0, (0, 0, 1.9)), row(3, 1, (0, 0, 1.9)), row(5, 0, (-9, 0, 1)), row(5, 1, (20, 0, 0.4))]
    t = spark.createDataFrame(traj, TRAJ)
    got = {(r["body_id"], r["frame"]): (round(r["support"], 6), r["support_id"]) for r in staging.support_among(t.select("clip_uid", "body_id", "frame", "px", "py", "pz", "radius"), t, spark.createDataFrame(bodies, BODIES), -1.0).collect()}
    assert got[(1, 0)] == (1.5, 2)  # bodies 2 and 5 tie at 1.5, 2 is declared first; 3 sleeps
    assert got[(1, 1)] == (0.9, 5)  # 2 has risen above; 5 is round and under everything
    assert got[(2, 1)] == (3.5, 1) and got[(2, 0)] == (0.1, 0)
    assert got[(5, 1)] == (-1.0, None)


def test_pair_contacts(spark):
    bodies = spark.createDataFrame([body(i) for i in (1, 2, 3)] + [body(4, dormant=True), body(5, True)], BODIES)
    path = {1: [(0, 0, 0), (0.2, 0, 0), (0.4, 0, 0), (1.0, 0, 0), (1.4, 0, 0), (1.4, 0, 0)], 2: [(2.4, 0, 0)] * 6, 3: [(9, 9, 9), (9, 9, 9), (9, 9, 9), (9, 9, 9), (9, 9, 9), (9, 9, 9)]}
    speed = {1: (2, 0, 0), 2: (0, 0, 0), 3: (0, 9, 9)}
    traj = spark.createDataFrame([row(i, f, p, speed[i]) for i, ps in path.items() for f, p in enumerate(ps)] + [row(4, f, (0, 0, 0)) for f in range(6)], TRAJ)

    def first(*contacts, prefer=None):
        found = spark.createDataFrame([(1, f, n, a, b) for n, (f, a, b) in enumerate(contacts)], "clip_uid long, frame int, seq int, body_a long, body_b long")
        return [(r["frame"], r["body_a"], r["body_b"]) for r in staging.pair_contacts(found, traj, bodies, prefer).collect()]

    assert first((1, 1, 2)) == [(4, 1, 2)]  # recorded early, stands where the gap closes
    assert first((0, 1, 2), (2, 1, 4), (2, 1, 5)) == []  # frame 0, a sleeper and a static body
    assert first((2, 3, 1)) == []  # moves away: not closing
    assert first((2, 2, 3), (1, 1, 2)) == [(4, 1, 2)]  # 2 and 3 never meet and do not close in
    assert first((3, 1, 3), (1, 1, 2)) == [(4, 1, 2)]
    assert first((1, 1, 2), prefer=F.col("body_id") == 3) == [(4, 1, 2)]


def test_camera_poses(spark):
    scenes = [(1, 5, "orbit", 10.0, 0.0, 0.0, 0.0, 10.0, 0.0), (2, 5, "push", 0.0, 0.0, 0.0, 4.0, 8.0, 0.0), (3, 3, "static", 1.0, 2.0, 3.0, 9.0, 9.0, 9.0), (4, 1, "orbit", 1.0, 0.0, 0.0, 0.0, 1.0, 0.0), (5, 3, "orbit", 0.0, 0.0, 0.0, 5.0, 0.0, 0.0), (6, 3, "orbit", 2.0, 0.0, 0.0, 4.0, 0.0, 0.0)]
    t = spark.createDataFrame([(*s, 0.0, 0.0, 0.0) for s in scenes], "clip_uid long, frames int, motion string, x0 double, y0 double, z0 double, x1 double, y1 double, z1 double, ax double, ay double, az double")
    got = {(r["clip_uid"], r["frame"]): (r["x"], r["y"], r["z"]) for r in staging.camera_poses(t).collect()}
    assert len(got) == 5 + 5 + 3 + 1 + 3 + 3
    for f in range(5):
        angle = math.pi / 2 * f / 4
        assert got[(1, f)] == pytest.approx((10 * math.cos(angle), 10 * math.sin(angle), 0.0), abs=1e-9)
        assert got[(2, f)] == pytest.approx((f, 2 * f, 0))
    assert all(got[(3, f)] == (1.0, 2.0, 3.0) for f in range(3)) and got[(4, 0)] == (1.0, 0.0, 0.0)
    assert all(got[(5, f)] == (0.0, 0.0, 0.0) for f in range(3))  # an arm without length stays
    assert got[(6, 1)] == pytest.approx((3.0, 0.0, 0.0))  # no turn: straight


def test_contamination_verdicts(spark):
    rows = lambda *r: spark.createDataFrame(r, "family string, clip_uid long, law string, r double")
    valid = spark.createDataFrame([(c, law, 0.5) for c in (1, 2) for law in ("own", "other", "plain")], "clip_uid long, law string, r double")
    invalid = rows(("a", 1, "own", 0.55), ("a", 2, "own", 0.5), ("a", 1, "other", 9.0), ("a", 2, "other", 0.5), ("a", 1, "plain", 9.0), ("b", 1, "own", 1.5), ("b", 1, "other", 0.7))
    owners = spark.createDataFrame([("own", "a"), ("other", "b")], "law string, family string")
    got = {(r["family"], r["law"]): (round(r["rise"], 6), r["clips_over"], r["verdict"]) for r in twins.contamination(valid, invalid, spark.createDataFrame([("a",), ("b",)], "family string"), owners).collect()}
    assert got == {("a", "own"): (0.05, 0, "silent"), ("a", "other"): (8.5, 1, "leak"), ("a", "plain"): (8.5, 1, "free"), ("b", "own"): (1.0, 0, "kept"), ("b", "other"): (0.2, 0, "kept")}


def test_overlap_windows(spark):
    bodies = spark.createDataFrame([body(1), body(2, True, box=True, at=(5, 0, 0), half=(1, 1, 1)), body(3)], BODIES)
    traj = spark.createDataFrame([row(1, f, (f, 0, 0)) for f in range(12)] + [row(3, f, (9, 0, 0)) for f in range(12)], TRAJ)

    def window(b, t0):
        pairs = spark.createDataFrame([(1, 1, b, t0)], "clip_uid long, body_a long, body_b long, t0 int")
        return [(r["s"], r["e"]) for r in staging.overlap_windows(traj, pairs, bodies).collect()]

    assert window(2, 2) == [(2, 8)]  # inside the box until x = 6, and two frames more
    assert window(2, 7) == [] and window(3, 2) == [(2, 11)] and window(3, 10) == []


def test_cells_of_the_matrix(spark):
    assert set(taxonomy.cells()) == {(r["family"], r["scenario"]) for r in taxonomy.matrix(spark).collect()}
