"""Where and when an edit can be staged: supports, contacts and frames chosen from whole recordings.

bodies: one row for each (clip_uid, body_id) with its order of declaration ``ord``, static, floor, dormant, box (an upright box, else
round), its declared place x0, y0, z0 and half sizes hx, hy, hz, q0 (the real part of its rotation) and radius.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawtrace.functions.vectors import dot, norm, vec
from lawtrace.operators.geometry import FRAME, first_contact, first_impact

BODY = ["clip_uid", "body_id"]


def top_of() -> Column:
    """The highest point of a static body; a round one's largest half size counts."""
    return F.col("z0") + F.when(F.col("box"), F.col("hz")).otherwise(F.greatest("hx", "hy", "hz"))


def support_among(points: DataFrame, traj: DataFrame, bodies: DataFrame, floor: float, slack: float = 1e-3) -> DataFrame:
    """``points`` (clip_uid, body_id, frame, px, py, pz, radius) with ``support`` and ``support_id``: the highest top under each at its
    frame, of static bodies and of those that move, the first declared on ties; the floor and null where there is none.

    Round bodies are under everything, so theirs is an as-of search in height: tops and lowest points of a frame in one order, and
    a running maximum. Boxes count above their declared footprint only; they meet the points of their clip in a join.
    Dormant bodies hold nothing up. No body of more than half the slack supports itself.
    """
    awake = bodies.where("not dormant")
    here = traj.select("clip_uid", "body_id", "frame", (F.col("pz") + F.col("radius")).alias("now"))
    moving = awake.where("not static").join(here, BODY).select("clip_uid", "frame", "body_id", "ord", "box", "x0", "y0", "hx", "hy", F.col("now").alias("top"))
    still = awake.where("static").select("clip_uid", "body_id", "ord", "box", "x0", "y0", "hx", "hy", top_of().alias("top"))
    p = points.withColumn("lowest", F.col("pz") - F.col("radius") + slack)
    best = F.struct("top", (-F.col("ord")).alias("low"), F.col("body_id").alias("support_id"))
    # of the static round ones of a clip any may be the highest below a point: they enter the order of each frame
    frames = p.select(*FRAME).distinct()
    round_tops = moving.where("not box").select(*FRAME, "top", best.alias("best")).unionByName(still.where("not box").join(frames, "clip_uid").select(*FRAME, "top", best.alias("best")))
    asked = p.select(*FRAME, F.col("lowest").alias("top"), F.col("body_id").alias("point"))
    up = Window.partitionBy(*FRAME).orderBy("top", F.col("point").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    swept = round_tops.unionByName(asked, allowMissingColumns=True).withColumn("best", F.max("best").over(up)).where("point is not null")
    over = (F.abs(F.col("px") - F.col("x0")) <= F.col("hx") + F.col("radius")) & (F.abs(F.col("py") - F.col("y0")) <= F.col("hy") + F.col("radius")) & (F.col("top") <= F.col("lowest"))
    q = p.select("clip_uid", F.col("body_id").alias("point"), "frame", "px", "py", "radius", "lowest")
    boxes = q.join(still.where("box"), "clip_uid").unionByName(q.join(moving.where("box"), FRAME).select(*q.columns, *still.columns[1:]))
    boxes = boxes.where(over & (F.col("body_id") != F.col("point"))).select(*FRAME, "point", best.alias("best"))
    found = swept.select(*FRAME, "point", "best").unionByName(boxes).groupBy(*FRAME, F.col("point").alias("body_id")).agg(F.max("best").alias("best"))
    out = points.join(found, ["clip_uid", "frame", "body_id"], "left")
    return out.withColumns({"support": F.coalesce("best.top", F.lit(float(floor))), "support_id": F.col("best.support_id")}).drop("best")


def pair_contacts(found: DataFrame, traj: DataFrame, bodies: DataFrame, prefer: Column | None = None, closing: float = 0.35, touch: float = 1.02) -> DataFrame:
    """``(clip_uid, frame, body_a, body_b)``: the first contact of two awake moving bodies that close in on each other.

    found: (clip_uid, frame, seq, body_a, body_b). A contact stands at the first frame, 1 <= f < T - 1, at which the pair's gap is within
    ``touch`` of their radii, else at the frame it is recorded, 1 at least. Contacts of the preferred body, ``prefer`` over (clip_uid, body_id), win
    outright; then the earliest, the first recorded on ties.
    """
    dynamic = bodies.where("not static and not dormant")
    names = lambda s: dynamic.select("clip_uid", F.col("body_id").alias(f"body_{s}"), (prefer if prefer is not None else F.lit(False)).alias(f"likes_{s}"))
    c = found.where("frame >= 1 and body_a <> body_b").select("clip_uid", "frame", "seq", "body_a", "body_b").join(names("a"), ["clip_uid", "body_a"]).join(names("b"), ["clip_uid", "body_b"])
    last = F.max("frame").over(Window.partitionBy("clip_uid"))
    rows = traj.withColumn("last", last)
    side = lambda s, shift=0: rows.select("clip_uid", (F.col("frame") + shift).alias("f"), F.col("body_id").alias(f"body_{s}"), *[F.col(x).alias(f"{s}_{x}") for x in ("px", "py", "pz", "vx", "vy", "vz", "radius", "last")])
    pairs = c.select("clip_uid", "body_a", "body_b").distinct()
    gaps = pairs.join(side("a"), ["clip_uid", "body_a"]).join(side("b"), ["clip_uid", "f", "body_b"])
    gap = norm(tuple(F.col(f"b_p{x}") - F.col(f"a_p{x}") for x in "xyz"))
    meets = gaps.where((gap <= touch * (F.col("a_radius") + F.col("b_radius"))) & (F.col("f") >= 1) & (F.col("f") < F.col("a_last"))).groupBy("clip_uid", "body_a", "body_b").agg(F.min("f").alias("meets"))
    c = c.join(meets, ["clip_uid", "body_a", "body_b"], "left").withColumn("f", F.coalesce("meets", "frame"))
    here, before = ["clip_uid", "f", "body_a"], ["clip_uid", "f", "body_b"]
    keep = lambda s, shift, cols, name: side(s, shift).select("clip_uid", "f", f"body_{s}", *[F.col(f"{s}_{x}").alias(f"{name}{x}") for x in cols])
    places, speeds = ("px", "py", "pz"), ("vx", "vy", "vz")
    c = c.join(keep("a", 0, places, "a_"), here).join(keep("b", 0, places, "b_"), before).join(keep("a", 1, speeds, "u_"), here).join(keep("b", 1, speeds, "w_"), before)
    apart = tuple(F.col(f"b_p{x}") - F.col(f"a_p{x}") for x in "xyz")
    size = norm(apart)
    speed = dot(tuple(F.col(f"u_v{x}") - F.col(f"w_v{x}") for x in "xyz"), apart) / F.greatest(size, F.lit(1e-12))
    c = c.where((size <= 1e-9) | (speed >= closing))
    order = F.struct(~(F.col("likes_a") | F.col("likes_b")), "f", "seq")
    return c.groupBy("clip_uid").agg(F.min_by(F.struct("f", "body_a", "body_b"), order).alias("best")).select("clip_uid", F.col("best.f").alias("frame"), "best.body_a", "best.body_b")


def last_dynamic_contacts(found: DataFrame, bodies: DataFrame) -> DataFrame:
    """``(clip_uid, body_id, frame)`` of every body: its last contact with another body that is not static, else -1."""
    ends = found.select("clip_uid", "frame", F.explode(F.array(F.struct(F.col("body_a").alias("body_id"), F.col("body_b").alias("other")), F.struct(F.col("body_b").alias("body_id"), F.col("body_a").alias("other")))).alias("e")).select("clip_uid", "frame", "e.*")
    moving = bodies.where("not static").select("clip_uid", F.col("body_id").alias("other"))
    last = ends.where("body_id <> other").join(moving, ["clip_uid", "other"], "left_semi").groupBy(*BODY).agg(F.max("frame").alias("last"))
    return bodies.select(*BODY).join(last, BODY, "left").select(*BODY, F.coalesce("last", F.lit(-1)).alias("frame"))


def event_contacts(actors: DataFrame, found: DataFrame, traj: DataFrame, bodies: DataFrame, floor: float) -> DataFrame:
    """``(clip_uid, body_id, priority, frame, partner_id, partner_static, nx, ny, nz)``: the contact to stage an event on, for each actor
    (clip_uid, body_id, t0: its default frame) that has one.

    Four relations are ranked, and the first that holds wins: 1, riding at t0 on a raised static body, the first declared whose box is within
    1.35 radii; 2, the first real impact; 3, the first contact of any kind; 4, what lies under the actor on frame 0, at the first frame
    at which it is not above that top, or after a third of the clip if it rests on it from the start. The first three must lie in 1 to T - 3, 4's third in 1 to
    T - 2; dormant partners do not count.
    """
    frames = traj.groupBy("clip_uid").agg((F.max("frame") + 1).alias("frames"))
    who = actors.join(frames, "clip_uid")
    fits = (F.col("frame") >= 1) & (F.col("frame") <= F.col("frames") - 3)
    up = {"nx": F.lit(0.0), "ny": F.lit(0.0), "nz": F.lit(1.0)}
    columns = ["clip_uid", "body_id", "priority", "frame", "partner_id", "nx", "ny", "nz"]
    at = traj.select(*BODY, "frame", "px", "py", "pz", "radius")

    raised = bodies.where("static and not floor").select("clip_uid", F.col("body_id").alias("partner_id"), "ord", "x0", "y0", "z0", "hx", "hy", "hz")
    on = who.withColumn("frame", F.col("t0")).where(fits).join(at, [*BODY, "frame"]).join(raised, "clip_uid").where(F.col("body_id") != F.col("partner_id"))
    gap = norm(tuple(F.greatest(F.abs(F.col(f"p{x}") - F.col(f"{x}0")) - F.col(f"h{x}"), F.lit(0.0)) for x in "xyz"))
    riding = on.where(gap <= 1.35 * F.col("radius")).groupBy(*BODY).agg(F.min_by(F.struct("frame", "partner_id"), "ord").alias("e")).select(*BODY, F.lit(1).alias("priority"), "e.frame", "e.partner_id", *[v.alias(k) for k, v in up.items()])

    asleep = bodies.where("dormant").select("clip_uid", F.col("body_id").alias("other"))
    awake = found.join(asleep.withColumnRenamed("other", "body_a"), ["clip_uid", "body_a"], "left_anti").join(asleep.withColumnRenamed("other", "body_b"), ["clip_uid", "body_b"], "left_anti")
    struck = first_impact(awake, traj).join(who, BODY).where(fits).select(*BODY, F.lit(2).alias("priority"), "frame", F.col("other").alias("partner_id"), "nx", "ny", "nz")
    touched = first_contact(awake).join(who, BODY).where(fits).select(*BODY, F.lit(3).alias("priority"), "frame", F.col("other").alias("partner_id"), *[v.alias(k) for k, v in up.items()])

    start = support_among(who.withColumn("frame", F.lit(0)).join(at, [*BODY, "frame"]), traj, bodies, floor).where("support_id is not null").select(*BODY, "support", "support_id", "frames")
    under = start.join(at, BODY).where(F.col("pz") - F.col("radius") <= F.col("support") + 1e-4).groupBy(*BODY, "support_id", "frames").agg(F.min("frame").alias("first"))
    third = F.floor(F.col("frames") / 3).cast("int")
    when = F.when(F.col("first") > 0, F.col("first")).when((third >= 1) & (third < F.col("frames") - 1), third)
    resting = under.select(*BODY, F.lit(4).alias("priority"), when.alias("frame"), F.col("support_id").alias("partner_id"), *[v.alias(k) for k, v in up.items()]).where("frame is not null")

    ranked = riding.select(*columns).unionByName(struck.select(*columns)).unionByName(touched.select(*columns)).unionByName(resting.select(*columns))
    best = ranked.groupBy(*BODY).agg(F.min_by(F.struct(*columns[2:]), F.struct("priority", "frame")).alias("e")).select(*BODY, "e.*")
    static = bodies.select("clip_uid", F.col("body_id").alias("partner_id"), "static")
    # what an actor rests on or rides counts as static, as it is held for the edit
    return best.join(static, ["clip_uid", "partner_id"]).withColumn("partner_static", F.col("static") | F.col("priority").isin(1, 4)).drop("static")


def stall_frames(traj: DataFrame, scenes: DataFrame, last_contact: DataFrame, span: int, want: float = 0.35, moving: float = 0.3, resume: float = 1.0) -> DataFrame:
    """``(clip_uid, body_id, frame, speed, cost)``: of the candidates the body and frame at which to hold it for ``span`` frames.

    traj: rows of candidate bodies with ``ord``; scenes: (clip_uid, frames, occluded array<int>). A frame fits if it lies after the body's last dynamic
    contact (from 1) and before T - span, if the body moves faster than ``moving``, and if the path still ahead up to frame T - span - 1
    is ``resume`` radii at least. Its cost is the distance from ``want`` of the clip, half to even, and three for each hidden frame of the
    span: a difference of two prefix sums. The least cost wins, then the first body, then the first frame.
    """
    whole = Window.partitionBy(*BODY)
    by = whole.orderBy("frame")
    counted = F.transform(F.sequence(F.lit(0), F.col("frames")), lambda f: F.size(F.filter(F.coalesce("occluded", F.array().cast("array<int>")), lambda o: o < f)))
    clips = scenes.select("clip_uid", "frames", counted.alias("hidden"))
    steps = F.coalesce(norm(tuple(F.col(f"p{x}") - F.lag(f"p{x}").over(by) for x in "xyz")), F.lit(0.0))
    t = traj.withColumn("step", steps).withColumns({"arc": F.sum("step").over(by.rowsBetween(Window.unboundedPreceding, 0)), "speed": norm(vec("v"))})
    t = t.join(clips, "clip_uid").join(last_contact.withColumnRenamed("frame", "last_contact"), BODY, "left")
    t = t.withColumn("end_arc", F.max(F.when(F.col("frame") == F.col("frames") - span - 1, F.col("arc"))).over(whole))
    fits = (F.col("frame") >= F.greatest(F.lit(1), F.coalesce("last_contact", F.lit(-1)) + 1)) & (F.col("frame") <= F.col("frames") - span - 1) & (F.col("speed") > moving) & (F.col("end_arc") - F.col("arc") >= resume * F.greatest(F.col("radius"), F.lit(1e-9)))
    aim = F.greatest(F.lit(1), F.bround(want * F.col("frames")).cast("int"))
    cost = F.abs(F.col("frame") - aim) + 3 * (F.get("hidden", F.col("frame") + span) - F.get("hidden", F.col("frame")))
    best = t.where(fits).withColumn("cost", cost).groupBy("clip_uid").agg(F.min_by(F.struct("body_id", "frame", "speed", "cost"), F.struct("cost", "ord", "frame")).alias("e"))
    return best.select("clip_uid", "e.*")


def hidden_behind(points: DataFrame, bodies: DataFrame, eye: tuple[Column, Column, Column]) -> DataFrame:
    """``points`` (a key, clip_uid and px, py, pz) with ``hidden``: whether the line from the eye meets an upright static box on its way.

    Boxes that are floors, lie flat (no higher than wide or deep) or are turned hide nothing. Each box of the clip is tested by slabs, in
    shares of the line: the point itself is at 1 without rounding, so a point on a face is behind it.
    """
    boxes = bodies.where((F.col("static")) & F.col("box") & ~F.col("floor") & (F.col("hz") > F.least("hx", "hy")) & (F.abs("q0") >= 0.999)).select("clip_uid", *[f"{x}0" for x in "xyz"], *[f"h{x}" for x in "xyz"])
    held = boxes.groupBy("clip_uid").agg(F.collect_list(F.struct(*boxes.columns[1:])).alias("boxes"))  # those of one clip
    ray = tuple(F.col(f"p{x}") - e for x, e in zip("xyz", eye))
    length = norm(ray)

    def meets(b: Column) -> Column:
        enter, leave, inside = F.lit(0.0), F.lit(1.0), F.lit(True)
        for x, e, d in zip("xyz", eye, ray):
            level = F.abs(d / F.greatest(length, F.lit(1e-12))) < 1e-9
            safe = F.when(level, 1.0).otherwise(d)
            near, far = (b[f"{x}0"] - b[f"h{x}"] - e) / safe, (b[f"{x}0"] + b[f"h{x}"] - e) / safe
            inside = inside & (~level | (F.abs(e - b[f"{x}0"]) <= b[f"h{x}"]))
            enter, leave = F.when(level, enter).otherwise(F.greatest(enter, F.least(near, far))), F.when(level, leave).otherwise(F.least(leave, F.greatest(near, far)))
        return inside & (enter <= leave)

    t = points.join(held, "clip_uid", "left")
    return t.withColumn("hidden", (length >= 1e-9) & F.coalesce(F.exists("boxes", meets), F.lit(False))).drop("boxes")


def camera_poses(scenes: DataFrame) -> DataFrame:
    """``(clip_uid, frame, x, y, z, ax, ay, az)``: the camera and its aim on every frame.

    scenes: clip_uid, frames, motion (static, orbit or a straight one), start x0, y0, z0, end x1, y1, z1, aim ax, ay, az. Straight motions go evenly
    from start to end. An orbit turns the direction from the aim at an even rate and blends the two arms with it, so equal radii stay; arms shorter than 1e-9
    stay at the start, and arms that do not differ in direction go straight. One frame is the start.
    """
    f = scenes.withColumn("frame", F.explode(F.sequence(F.lit(0), F.col("frames") - 1)))
    u = F.when((F.col("motion") == "static") | (F.col("frames") <= 1), 0.0).otherwise(F.col("frame") / F.greatest(F.col("frames") - 1, F.lit(1)))
    a, b = (tuple(F.col(f"{x}{i}") - F.col(f"a{x}") for x in "xyz") for i in (0, 1))
    ra, rb = norm(a), norm(b)
    turn = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / F.greatest(ra * rb, F.lit(1e-18)))))
    sine = F.when(turn >= 1e-6, F.sin(turn)).otherwise(1.0)
    round_ = (F.col("motion") == "orbit") & (u > 0)
    short = (ra < 1e-9) | (rb < 1e-9)
    straight = [(1 - u) * F.col(f"{x}0") + u * F.col(f"{x}1") for x in "xyz"]
    arc = [F.col(f"a{x}") + F.sin((1 - u) * turn) / sine * p + F.sin(u * turn) / sine * q for x, p, q in zip("xyz", a, b)]
    place = [F.when(round_ & short, F.col(f"{x}0")).when(round_ & (turn >= 1e-6), c).otherwise(s).alias(x) for x, s, c in zip("xyz", straight, arc)]
    return f.select("clip_uid", "frame", *place, "ax", "ay", "az")


def mass_ratio_outcome(found: DataFrame, traj: DataFrame, restitution: DataFrame, ratio: Column) -> DataFrame:
    """Velocities after each contact (clip_uid, seq) if body a weighed ``ratio`` times its mass: the one-dimensional outcome along the normal with the
    restitution of ``geometry.implied_restitution``, tangential parts as a frame before. Columns a_x.. and b_x.., and the normal parts ua, ub, va, vb."""
    side = lambda s: traj.select("clip_uid", (F.col("frame") + 1).alias("frame"), F.col("body_id").alias(f"body_{s}"), F.col("mass").alias(f"m_{s}"), *[F.col(f"v{x}").alias(f"{s}{x}") for x in "xyz"])
    t = found.join(side("a"), ["clip_uid", "frame", "body_a"]).join(side("b"), ["clip_uid", "frame", "body_b"]).join(restitution.select("clip_uid", "seq", "restitution"), ["clip_uid", "seq"])
    t = t.withColumns({"ua": dot(vec("a"), vec("n")), "ub": dot(vec("b"), vec("n")), "ma": ratio * F.col("m_a")})
    total, momentum = F.col("ma") + F.col("m_b"), F.col("ma") * F.col("ua") + F.col("m_b") * F.col("ub")
    gain = F.col("restitution") * (F.col("ub") - F.col("ua"))
    t = t.withColumns({"va": (momentum + F.col("m_b") * gain) / total, "vb": (momentum - F.col("ma") * gain) / total})
    after = [(F.col(f"{s}{x}") + (F.col(f"v{s}") - F.col(f"u{s}")) * F.col(f"n{x}")).alias(f"{s}_{x}") for s in "ab" for x in "xyz"]
    return t.select("clip_uid", "seq", "ua", "ub", "va", "vb", *after)


def overlap_windows(traj: DataFrame, pairs: DataFrame, bodies: DataFrame, tail: int = 2) -> DataFrame:
    """``(clip_uid, s, e)``: the window of a suppressed pair (clip_uid, body_a, body_b, t0), which violation, intervention and consequence share.

    It runs from t0 to the last frame from there on at which they overlap, and ``tail`` more within the clip: body a's sphere with a static partner's box, or
    two spheres. No overlap from t0 on, or an end at t0, leaves no row: windows stay as they are.
    """
    frames = traj.groupBy("clip_uid").agg(F.max("frame").alias("last"))
    a = traj.select("clip_uid", F.col("body_id").alias("body_a"), "frame", *[F.col(f"p{x}").alias(f"a{x}") for x in "xyz"], F.col("radius").alias("ra"))
    b = traj.select("clip_uid", F.col("body_id").alias("body_b"), "frame", *[F.col(f"p{x}").alias(f"b{x}") for x in "xyz"], F.col("radius").alias("rb"))
    t = pairs.join(bodies.select("clip_uid", F.col("body_id").alias("body_b"), "static", *[f"{x}0" for x in "xyz"], *[f"h{x}" for x in "xyz"]), ["clip_uid", "body_b"])
    t = t.join(a, ["clip_uid", "body_a"]).where("frame >= t0").join(b, ["clip_uid", "body_b", "frame"], "left")
    box = norm(tuple(F.greatest(F.abs(F.col(f"a{x}") - F.col(f"{x}0")) - F.col(f"h{x}"), F.lit(0.0)) for x in "xyz")) < F.col("ra")
    spheres = norm(tuple(F.col(f"a{x}") - F.col(f"b{x}") for x in "xyz")) < F.col("ra") + F.col("rb")
    last = t.where(F.when(F.col("static"), box).otherwise(F.coalesce(spheres, F.lit(False)))).groupBy("clip_uid", "t0").agg(F.max("frame").alias("e"))
    ends = last.join(frames, "clip_uid").select("clip_uid", F.col("t0").alias("s"), F.least(F.col("e") + tail, F.col("last")).alias("e"))
    return ends.where("e > s")
