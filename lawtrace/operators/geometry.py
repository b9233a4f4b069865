"""Contacts, supports, cameras and frame choices. Pairs are formed only inside one (clip, frame)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawtrace.functions.vectors import cross, dot, norm, sub, vec

FRAME = ["clip_uid", "frame"]


def pair_distances(traj: DataFrame, reach: Column, tolerance: float = 0.0) -> DataFrame:
    """Present bodies a before b whose centres are within ``reach`` (of radius_a, radius_b): an equality join on
    (clip, frame) with the distance as its condition."""
    t = traj.where("present")
    a = t.select(*FRAME, F.col("body_id").alias("body_a"), *[F.col(f"p{x}").alias(f"a{x}") for x in "xyz"], F.col("radius").alias("radius_a"))
    b = t.select(*FRAME, F.col("body_id").alias("body_b"), *[F.col(f"p{x}").alias(f"b{x}") for x in "xyz"], F.col("radius").alias("radius_b"))
    both = a.join(b, FRAME).where(F.col("body_a") < F.col("body_b"))
    gap = norm(sub(vec("a"), vec("b")))
    return both.withColumn("distance", gap).where(gap <= reach + tolerance).select(*FRAME, "body_a", "body_b", "distance", "radius_a", "radius_b")


def contacts(traj: DataFrame, ground: float, tolerance: float = 0.02) -> DataFrame:
    """Geometric contacts: overlapping spheres, and bodies whose lowest point is on the ground (body_b null). A sphere's
    radius is the body's times its mean scale."""
    traj = traj.withColumn("radius", F.col("radius") * (F.col("sx") + F.col("sy") + F.col("sz")) / 3)
    bodies = pair_distances(traj, F.col("radius_a") + F.col("radius_b"), tolerance).select(*FRAME, "body_a", "body_b")
    floor = traj.where("present").where(F.col("pz") - F.col("radius") <= ground + tolerance).select(*FRAME, F.col("body_id").alias("body_a"), F.lit(None).cast("long").alias("body_b"))
    return bodies.unionByName(floor)


def steady_mean(value: str, by: str = "frame") -> Column:
    """The mean of a group's values, added in the order of ``by``: the same number however the rows are dealt. A group is one list, so it is
    meant for the frames of a body."""
    held = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(by, value))))
    return F.aggregate(held, F.lit(0.0), lambda s, x: s + x[value], lambda s: s / F.nullif(F.size(held), F.lit(0)))


def support_below(points: DataFrame, surfaces: DataFrame, floor: float, slack: float = 1e-3) -> DataFrame:
    """``points`` (clip_uid, px, py, pz, radius) with the highest surface (clip_uid, ord, cx, cy, hx, hy, top) under each:
    its footprint holds the point and its top is not above the lowest point; the first declared on ties, else the floor.
    """
    s = surfaces.select("clip_uid", "ord", "cx", "cy", "hx", "hy", "top")
    keyed = points.withColumn("point", F.monotonically_increasing_id()) if "point" not in points.columns else points
    over = (F.abs(F.col("px") - F.col("cx")) <= F.col("hx") + F.col("radius")) & (F.abs(F.col("py") - F.col("cy")) <= F.col("hy") + F.col("radius")) & (F.col("top") <= F.col("pz") - F.col("radius") + slack)
    hits = keyed.join(s, "clip_uid").where(over).groupBy("point").agg(F.max(F.struct("top", -F.col("ord"))).alias("best"))
    return keyed.join(hits, "point", "left").withColumn("support", F.coalesce("best.top", F.lit(float(floor)))).drop("best")


def height_under(x: Column, y: Column, bounds: tuple[float, float, float, float], top: float, floor: float) -> Column:
    cx, cy, hx, hy = bounds
    return F.when((F.abs(x - cx) <= hx) & (F.abs(y - cy) <= hy), float(top)).otherwise(float(floor))


def camera_basis(position: tuple[Column, ...], target: tuple[Column, ...]) -> tuple:
    """Unit forward, right and up of a camera that keeps z upright."""
    def unit(v):
        n = F.greatest(norm(v), F.lit(1e-12))
        return tuple(c / n for c in v)

    forward = unit(sub(target, position))
    right = unit(cross(forward, (F.lit(0.0), F.lit(0.0), F.lit(1.0))))
    return forward, right, cross(right, forward)


def in_view(point: tuple[Column, ...], position: tuple[Column, ...], target: tuple[Column, ...], half_width: float, half_height: float, margin: float = 0.04) -> Column:
    """Inside the frustum, less a margin of the screen; never behind the camera."""
    forward, right, up = camera_basis(position, target)
    d = sub(point, position)
    z = dot(d, forward)
    inside = lambda axis, half: F.abs(dot(d, axis)) <= (1 - margin) * half * z
    return (z > 1e-3) & inside(right, half_width) & inside(up, half_height)


def hidden_by_box(eye: tuple[Column, ...], point: tuple[Column, ...], low: tuple[Column, ...], high: tuple[Column, ...]) -> Column:
    """Whether the segment from the eye to the point enters the box before the point."""
    enter, leave, parallel = F.lit(0.0), F.lit(1.0), F.lit(True)
    for e, p, a, b in zip(eye, point, low, high):
        d = p - e
        flat = F.abs(d) < 1e-12
        t0, t1 = (a - e) / F.when(flat, 1.0).otherwise(d), (b - e) / F.when(flat, 1.0).otherwise(d)
        parallel = parallel & (~flat | ((e >= a) & (e <= b)))
        enter, leave = F.when(flat, enter).otherwise(F.greatest(enter, F.least(t0, t1))), F.when(flat, leave).otherwise(F.least(leave, F.greatest(t0, t1)))
    return parallel & (enter <= leave) & (enter < 1.0)


def unsupported(top: Column | float, fps: float) -> Column:
    """Above the surface and not within a frame of a bounce: a fall that turns into a rise where the body is within reach of
    the surface at either of the two frames. The first frame is next to no bounce."""
    by = Window.partitionBy("clip_uid", "body_id").orderBy("frame")
    height, vz = F.col("pz") - F.col("radius") - top, F.col("vz")
    reaches = height < F.greatest(F.lit(0.05), F.abs(vz) / fps * 1.5)
    bounce = F.coalesce((F.lag(vz).over(by) < -1e-3) & (vz > 1e-3) & (reaches | F.lag(reaches).over(by)), F.lit(False))
    return (height > 1e-3) & (~F.max(bounce).over(by.rowsBetween(-1, 1)) | (F.row_number().over(by) == 1))


def uncaused(traj: DataFrame, touching: DataFrame, t0: Column, fps: float, gravity: float = 9.81, least: float = 0.15) -> DataFrame:
    """Frames from max(1, t0) where a body speeds up by more than gravity explains, with no contact within two frames.

    touching: (clip_uid, body_id, frame)."""
    by = Window.partitionBy("clip_uid", "body_id").orderBy("frame")
    t = traj.join(touching.distinct().withColumn("touch", F.lit(True)), ["clip_uid", "body_id", "frame"], "left")
    dv = norm((F.col("vx") - F.lag("vx").over(by), F.col("vy") - F.lag("vy").over(by), F.col("vz") - F.lag("vz").over(by) + gravity / fps))
    speed = norm(vec("v"))
    t = t.withColumn("speed", speed).withColumns({"dv": dv, "near": F.coalesce(F.max("touch").over(by.rowsBetween(-2, 2)), F.lit(False))})
    t = t.withColumn("faster", F.col("speed") > F.lag("speed").over(by))
    return t.where((F.col("dv") > least) & F.col("faster") & ~F.col("near") & (F.col("frame") >= F.greatest(F.lit(1), t0))).select("clip_uid", "body_id", "frame")


def off_screen_frames(traj: DataFrame, seen: Column, t0: Column, share: float = 0.6) -> DataFrame:
    """Per clip, frames from t0 on where less than ``share`` of the present culprits are in view; a frame without present
    culprits counts as in view."""
    per = traj.where(F.col("frame") >= t0).groupBy(*FRAME).agg(F.count_if(F.col("present")).alias("here"), F.count_if(F.col("present") & seen).alias("seen"))
    return per.groupBy("clip_uid").agg(F.count_if(F.col("seen") < share * F.col("here")).alias("frames"))


def _ends(found: DataFrame, *more: str) -> DataFrame:
    """Two rows for each contact, one for each end: body_id and other."""
    ends = F.array(*[F.struct(F.col(x).alias("body_id"), F.col(y).alias("other")) for x, y in (("body_a", "body_b"), ("body_b", "body_a"))])
    return found.select("clip_uid", "frame", "seq", *more, F.explode(ends).alias("e")).select("clip_uid", "frame", "seq", *more, "e.*")


def first_contact(found: DataFrame) -> DataFrame:
    """``(clip_uid, body_id, frame, other)`` of each body's earliest contact, the first recorded on ties.

    found: (clip_uid, frame, seq, body_a, body_b)."""
    return _ends(found).groupBy("clip_uid", "body_id").agg(F.min("frame").alias("frame"), F.min_by("other", F.struct("frame", "seq")).alias("other"))


def first_impact(found: DataFrame, traj: DataFrame, least_speed: float = 0.3, head_on: float = 0.3) -> DataFrame:
    """``(clip_uid, body_id, frame, other, nx, ny, nz)``: each body's earliest contact, 1 <= f < T, that it meets with speed, mostly along the normal, by
    its velocity a frame before; the unit normal with it. Contacts without a normal do not count."""
    last = F.max("frame").over(Window.partitionBy("clip_uid"))
    before = traj.select("clip_uid", "body_id", (F.col("frame") + 1).alias("frame"), "vx", "vy", "vz", last.alias("last"))
    size = norm(vec("n"))
    t = _ends(found, "nx", "ny", "nz").where("frame >= 1").join(before, ["clip_uid", "body_id", "frame"]).where((F.col("frame") <= F.col("last")) & (size >= 1e-6))
    speed, along = norm(vec("v")), F.abs(dot(vec("v"), vec("n"))) / size
    unit = [(F.col(f"n{x}") / size).alias(f"n{x}") for x in "xyz"]
    best = t.where((speed >= least_speed) & (along >= head_on * speed)).groupBy("clip_uid", "body_id").agg(F.min_by(F.struct("frame", "other", *unit), F.struct("frame", "seq")).alias("e"))
    return best.select("clip_uid", "body_id", "e.*")


def head_on_contact(found: DataFrame, traj: DataFrame) -> DataFrame:
    """Per (clip, frame): the contact whose normal body a's velocity is most along, the first recorded on ties."""
    v = traj.select("clip_uid", "frame", F.col("body_id").alias("body_a"), "vx", "vy", "vz")
    t = found.join(v, ["clip_uid", "frame", "body_a"]).withColumn("along", F.abs(dot(vec("v"), vec("n"))))
    return t.groupBy(*FRAME).agg(F.max_by("seq", F.struct("along", -F.col("seq"))).alias("seq"), F.max("along").alias("along"))


def approach_speed(found: DataFrame, traj: DataFrame) -> DataFrame:
    """Speed at the frame before each contact: relative to the partner where it has a row there, else absolute."""
    def side(body: str, p: str) -> DataFrame:
        return traj.select("clip_uid", (F.col("frame") + 1).alias("frame"), F.col("body_id").alias(body), *[F.col(f"v{x}").alias(f"{p}{x}") for x in "xyz"])

    t = found.join(side("body_a", "a"), ["clip_uid", "frame", "body_a"]).join(side("body_b", "b"), ["clip_uid", "frame", "body_b"], "left")
    return t.select("clip_uid", "frame", "seq", norm(tuple(F.col(f"a{x}") - F.coalesce(f"b{x}", F.lit(0.0)) for x in "xyz")).alias("speed"))


def first_outside_contact(found: DataFrame, bodies: DataFrame, frames: DataFrame) -> DataFrame:
    """Per clip the first frame, 1 <= f < T - 2, at which a body of the group touches one outside it that is neither static nor dormant.

    bodies: (clip_uid, body_id, inside, outside); frames: (clip_uid, frames)."""
    side = lambda s: bodies.select("clip_uid", F.col("body_id").alias(f"body_{s}"), F.col("inside").alias(f"in_{s}"), F.col("outside").alias(f"out_{s}"))
    t = found.join(side("a"), ["clip_uid", "body_a"]).join(side("b"), ["clip_uid", "body_b"]).join(frames, "clip_uid")
    hit = (F.col("in_a") & F.col("out_b")) | (F.col("in_b") & F.col("out_a"))
    return t.where(hit & (F.col("frame") >= 1) & (F.col("frame") < F.col("frames") - 2)).groupBy("clip_uid").agg(F.min("frame").alias("frame"))


def first_landing(traj: DataFrame, top: float, margin: int = 1) -> DataFrame:
    """Per clip the first frame at which any body lands, less a margin; null if that is before frame 1."""
    found = traj.where(F.col("pz") - F.col("radius") <= top + 1e-2).groupBy("clip_uid").agg((F.min("frame") - margin).alias("frame"))
    return found.withColumn("frame", F.when(F.col("frame") >= 1, F.col("frame")))


def merge_candidates(traj: DataFrame, reach: float, frames: Column) -> DataFrame:
    """Pairs of bodies that ever come within ``reach`` radii, 1 <= f < T - 2: first such frame and its gap."""
    near = pair_distances(traj, (F.col("radius_a") + F.col("radius_b")) * reach).join(traj.select("clip_uid", frames.alias("frames")).distinct(), "clip_uid")
    near = near.where((F.col("frame") >= 1) & (F.col("frame") < F.col("frames") - 2))
    return near.groupBy("clip_uid", "body_a", "body_b").agg(F.min("frame").alias("frame"), F.min_by("distance", "frame").alias("gap"))


def greedy_pairs(candidates: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` disjoint pairs of each clip, by frame, gap and ids: sequential inside a clip, whose candidates are
    bounded by its bodies squared."""

    def pick(table):
        import pyarrow as pa

        rows = sorted(table.to_pylist(), key=lambda x: (x["frame"], x["gap"], x["body_a"], x["body_b"]))
        used, out = set(), []
        for x in rows:
            if len(out) < most and not used & {x["body_a"], x["body_b"]}:
                used |= {x["body_a"], x["body_b"]}
                out.append(x)
        return pa.Table.from_pylist(out, schema=table.schema)

    return candidates.groupBy("clip_uid").applyInArrow(pick, candidates.schema)


def nearest_frame(rows: DataFrame, want: Column, ok: Column) -> DataFrame:
    """Per (clip, body) the allowed frame nearest to ``want``, the earlier of two."""
    t = rows.where(ok).withColumn("off", F.abs(F.col("frame") - want))
    return t.groupBy("clip_uid", "body_id").agg(F.min_by("frame", F.struct("off", "frame")).alias("frame"))


def clear_frame(rows: DataFrame, want: Column, span: int, hidden: Column) -> DataFrame:
    """Per (clip, body) the frame nearest to ``want``, the earlier of two, from which ``span`` frames are all in sight;
    ``want`` itself where nothing is ever hidden or no frame will do. Null if it is not in 1 <= f < T - 1."""
    of = Window.partitionBy("clip_uid", "body_id")
    t = rows.withColumns({"want": want, "hidden": hidden, "frames": F.count("*").over(of)}).withColumn("shut", F.max("hidden").over(of.orderBy("frame").rowsBetween(0, span - 1)))
    fits = (F.col("frame") >= 1) & (F.col("frame") < F.col("frames") - 1) & ~F.col("shut")
    found = t.groupBy("clip_uid", "body_id").agg(F.min_by("frame", F.when(fits, F.struct(F.abs(F.col("frame") - F.col("want")), "frame"))).alias("found"), F.max("hidden").alias("ever"), F.max("frames").alias("frames"), F.max("want").alias("want"))
    asked = F.when((F.col("want") >= 1) & (F.col("want") < F.col("frames") - 1), F.col("want"))
    return found.select("clip_uid", "body_id", F.when(F.col("ever"), F.coalesce("found", asked)).otherwise(asked).cast("int").alias("frame"))


def fast_frame(rows: DataFrame, want: Column, share: float = 0.6) -> DataFrame:
    """Nearest frame to ``want`` with at least ``share`` of the body's peak speed, 1 <= f < T - 1."""
    whole = Window.partitionBy("clip_uid", "body_id")
    speed = norm(vec("v"))
    t = rows.withColumn("speed", speed).withColumns({"peak": F.max("speed").over(whole), "last": F.max("frame").over(whole)})
    return nearest_frame(t, want, (F.col("speed") >= share * F.col("peak")) & (F.col("frame") >= 1) & (F.col("frame") < F.col("last")))


def event_frame(occluded: Column, frames: Column, unit: Column) -> Column:
    """Middle of the occluded frames, else (0.35 ± 0.10) of the clip by the unit number; null outside [1, T - 2]."""
    middle = F.when(F.size(occluded) > 0, F.floor((F.array_min(occluded) + F.array_max(occluded)) / 2))
    chosen = F.coalesce(middle, F.bround((0.35 + 0.10 * (2 * unit - 1)) * frames)).cast("int")
    return F.when((chosen >= 1) & (chosen <= frames - 2), chosen)


def camera_track(scenes: DataFrame) -> DataFrame:
    """``(clip_uid, frame, x, y, z)`` from start to end positions (x0.., x1..) over ``frames``; static scenes stay put."""
    f = scenes.withColumn("frame", F.explode(F.sequence(F.lit(0), F.col("frames") - 1)))
    u = F.when(F.col("motion") == "static", 0.0).otherwise(F.col("frame") / F.greatest(F.col("frames") - 1, F.lit(1)))
    return f.select("clip_uid", "frame", *[(F.col(f"{a}0") + (F.col(f"{a}1") - F.col(f"{a}0")) * u).alias(a) for a in "xyz"])


def pulse(n: Column, i: Column, peak: float, base: float, hold: float) -> Column:
    """Step i of a base-peak-base pulse of n frames; the plateau never vanishes."""
    ramp = F.least(F.greatest(F.lit(1), F.bround((1 - hold) * n / 2).cast("int")), F.greatest(F.ceil(n / 2) - 1, F.lit(0)).cast("int"))
    up = F.when(ramp > 0, F.least((i + 1) / (F.greatest(ramp, F.lit(1)) + 1), F.lit(1.0))).otherwise(1.0)
    down = F.when(ramp > 0, F.least((n - i) / (F.greatest(ramp, F.lit(1)) + 1), F.lit(1.0))).otherwise(1.0)
    return base + (peak - base) * F.least(up, down)


def behind_screen(eye: tuple[float, float, float], centre: tuple[float, float, float], half: tuple[float, float], silhouette: Column) -> Column:
    """Whether a body is fully hidden by an upright screen (half width and height) across y: the ray from the eye meets
    the screen's plane inside it, less the silhouette's projection there. Bodies in front of the screen are not."""
    along = (centre[1] - eye[1]) / F.when(F.col("py") > centre[1], F.col("py") - eye[1])
    x, z, r = eye[0] + along * (F.col("px") - eye[0]), eye[2] + along * (F.col("pz") - eye[2]), silhouette * along
    hidden = (F.abs(x - centre[0]) <= half[0] - r) & (z >= centre[2] - half[1] + r) & (z <= centre[2] + half[1] - r)
    return F.coalesce(hidden, F.lit(False))


def implied_restitution(found: DataFrame, traj: DataFrame, frames: int = 4) -> DataFrame:
    """Per contact (clip_uid, seq): approach along the normal a frame before, and the restitution its outcome implies.

    The outcome is the first of ``frames`` frames from the contact on in which the two separate, else the approach
    itself; the restitution is within 0.05 and 1, and 0.5 where nothing approached. A measurement: nothing is re-solved.
    """
    def side(body: str, p: str) -> DataFrame:
        return traj.select("clip_uid", F.col("frame").alias("f"), F.col("body_id").alias(body), *[F.col(f"v{x}").alias(f"{p}{x}") for x in "xyz"])

    steps = found.withColumn("step", F.explode(F.sequence(F.lit(-1), F.lit(frames - 1)))).withColumn("f", F.col("frame") + F.col("step"))
    t = steps.join(side("body_a", "a"), ["clip_uid", "f", "body_a"]).join(side("body_b", "b"), ["clip_uid", "f", "body_b"])
    t = t.withColumns({"ua": dot(vec("a"), vec("n")), "ub": dot(vec("b"), vec("n"))})
    before = lambda c: F.max(F.when(F.col("step") == -1, F.col(c)))
    apart = F.min_by(F.col("ub") - F.col("ua"), F.when((F.col("step") >= 0) & (F.col("ub") - F.col("ua") > 1e-3), F.col("step")))
    g = t.groupBy("clip_uid", "seq").agg((before("ua") - before("ub")).alias("approach"), apart.alias("apart")).where("approach is not null")
    after = F.coalesce("apart", -F.col("approach"))
    e = F.when(F.abs("approach") < 1e-6, 0.5).otherwise(F.least(F.greatest(after / F.when(F.abs("approach") >= 1e-6, F.col("approach")), F.lit(0.05)), F.lit(1.0)))
    return g.select("clip_uid", "seq", "approach", e.alias("restitution"))
