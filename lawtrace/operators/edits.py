"""Labelled perturbed twins from lawful trajectories: closed-form edits of the rows from ``t0`` on.

Every edit takes the table, the culprit condition as a column, and t0 as a column, and leaves earlier frames and other
bodies as they are. ``EDITS`` maps a family to its edit, so adding one is a plug-in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawtrace.functions.vectors import clip, smoothstep

KEY = ("clip_uid", "body_id")


def by_frame():
    return Window.partitionBy(*KEY).orderBy("frame")


def whole():
    return Window.partitionBy(*KEY)

XYZ = "xyz"
#: FIXED VALUES: strengths of every edit at its three severities.
STRENGTHS = {
    "teleport": {"weak": 1.5, "medium": 4.0, "strong": 9.0}, "halt": {"weak": 0.55, "medium": 0.85, "strong": 1.0}, "wiggle": {"weak": 0.5, "medium": 0.9, "strong": 1.5},
    "drop_out": {"weak": 0.25, "medium": 0.55, "strong": 1.0}, "time_slip": {"weak": 0.13, "medium": 0.22, "strong": 0.32}, "resize": {"weak": 1.30, "medium": 1.75, "strong": 2.30},
    "fade": {"weak": 0.45, "medium": 0.28, "strong": 0.16}, "squash": {"weak": 1.35, "medium": 1.9, "strong": 2.8}, "retime": {"weak": 0.55, "medium": 0.28, "strong": 0.08},
    "hover": {"weak": 0.8, "medium": 2.0, "strong": 3.6}, "recolour": {"weak": 0.25, "medium": 0.60, "strong": 1.30}, "detach": {"weak": 1.2, "medium": 3.0, "strong": 5.5}, "invert": {"weak": 0.15, "medium": -0.4, "strong": -1.0},
}
EDITS: dict[str, Callable[..., DataFrame]] = {}


#: The family that each edit stages.
FAMILY = {
    "teleport": "continuity", "halt": "newton1_inertia", "wiggle": "non_parabolic", "drop_out": "permanence", "resize": "immutability", "fade": "dissolve", "squash": "deformation", "hover": "support",
    "recolour": "colour_shift", "detach": "shadow", "invert": "shadow_inverted", "time_slip": "time_slip", "retime": "friction", "dip": "solidity", "merge": "fusion",
}
#: FIXED VALUE: the least share of its size that a body shrinks to.
SHRINK_TO = 0.42


def edit(f):
    EDITS[f.__name__] = f
    return f


def draw(*key: Column, salt: str) -> Column:
    """A number in [0, 1) fixed by the key and the salt alone, at any parallelism."""
    return F.crc32(F.concat_ws("|", *[k.cast("string") for k in key], F.lit(salt))) / F.lit(4294967296.0)


def at_frame(column: str, frame: Column) -> Column:
    """The body's own value at another frame."""
    return F.max(F.when(F.col("frame") == frame, F.col(column))).over(whole())


def changed(traj: DataFrame, when: Column, **columns: Column) -> DataFrame:
    return traj.withColumns({c: F.when(when, v).otherwise(F.col(c)) for c, v in columns.items()})


def late(who: Column, t0: Column) -> Column:
    return who & (F.col("frame") >= t0)


@edit
def teleport(traj: DataFrame, who: Column, t0: Column, radii: float) -> DataFrame:
    """The body stands ``radii`` radii further along x from t0 on."""
    return changed(traj, late(who, t0), px=F.col("px") + radii * F.col("radius"))


@edit
def halt(traj: DataFrame, who: Column, t0: Column) -> DataFrame:
    """The pose of t0 - 1 is held and all velocities are zero."""
    pose = ("px", "py", "pz", "qw", "qx", "qy", "qz")
    return changed(traj, late(who, t0), **{c: at_frame(c, t0 - 1) for c in pose}, **{f"{p}{a}": F.lit(0.0) for p in "vw" for a in XYZ})


@edit
def wiggle(traj: DataFrame, who: Column, t0: Column, t1: Column, radii: float, cycles: float = 1.75, top: float = 0.0, fps: float | None = None) -> DataFrame:
    """A sideways sine under a squared-sine envelope over [t0, t1], kept above the surface. With ``fps`` the velocities of the edited bodies are
    differenced anew from their positions, all clip long."""
    u = (F.col("frame") - t0) / F.greatest(t1 - t0, F.lit(1))
    wave = F.sin(2 * F.pi() * cycles * u) * F.pow(F.sin(F.pi() * u), F.lit(2.0)) * radii * F.col("radius")
    inside = late(who, t0) & (F.col("frame") <= t1)
    out = changed(traj, inside, py=F.col("py") + wave, pz=F.greatest(F.col("pz"), top + F.col("radius")))
    if fps is None:
        return out
    own = [f"v{a}" for a in XYZ]
    again = resynced(out.withColumns({f"_{c}": F.col(c) for c in own}), fps)
    return again.withColumns({c: F.when(who, F.col(c)).otherwise(F.col(f"_{c}")) for c in own}).select(*out.columns)


@edit
def drop_out(traj: DataFrame, who: Column, t0: Column, t1: Column) -> DataFrame:
    """Absent on [t0, t1] with the pose held."""
    pose = ("px", "py", "pz", "qw", "qx", "qy", "qz")
    inside = late(who, t0) & (F.col("frame") <= t1)
    return changed(traj, inside, present=F.lit(False), **{c: at_frame(c, t0) for c in pose})


@edit
def time_slip(traj: DataFrame, who: Column, t0: Column, n: Column) -> DataFrame:
    """The body stands still for n frames and then replays its own path n frames late: a self-join on the source frame."""
    pose = ("px", "py", "pz", "qw", "qx", "qy", "qz", "vx", "vy", "vz", "wx", "wy", "wz")
    t = traj.withColumn("src", F.when(late(who, t0), F.greatest(t0, F.col("frame") - n)).otherwise(F.col("frame")).cast("int"))
    src = traj.select(*KEY, F.col("frame").alias("src"), *[F.col(c).alias(f"s_{c}") for c in pose])
    return t.join(src, [*KEY, "src"], "left").withColumns({c: F.col(f"s_{c}") for c in pose}).select(*traj.columns)


def ramp(t0: Column, frames: Column) -> Column:
    return smoothstep((F.col("frame") - t0 + 1) / frames)


def resize_factor(strength: float, grow: Column) -> Column:
    """The size a body grows to, or shrinks to by as much, but to no less than ``SHRINK_TO`` of itself."""
    return F.when(grow, float(strength)).otherwise(max(SHRINK_TO, 1.0 / strength))


def reseated(half: Column, top: float) -> Column:
    """The height at which a body of another half height keeps the clearance it had; one in the surface is put on it."""
    return top + half + F.greatest(F.lit(0.0), F.col("pz") - F.col("radius") - top)


@edit
def resize(traj: DataFrame, who: Column, t0: Column, factor: Column | float, frames: int = 6, top: float = 0.0) -> DataFrame:
    """All axes go to ``factor`` along an eased ramp, and the body keeps its clearance."""
    k = 1 + (factor - 1) * ramp(t0, F.lit(frames))
    return changed(traj, late(who, t0), pz=reseated(F.col("radius") * k, top), **{f"s{a}": F.col(f"s{a}") * k for a in XYZ})


@edit
def fade(traj: DataFrame, who: Column, t0: Column, frames: Column) -> DataFrame:
    """Opacity falls to nothing over ``frames``, then the body is absent."""
    gone = F.col("frame") >= t0 + frames
    return changed(traj, late(who, t0), opacity=F.col("opacity") * (1 - ramp(t0, frames)), present=F.col("present") & ~gone)


@edit
def squash(traj: DataFrame, who: Column, t0: Column, factor: float, frames: int = 6, axis: Column | None = None, top: float = 0.0) -> DataFrame:
    """One axis ("x" if none is named) grows and the others shrink so that the volume stays, and the body keeps its clearance."""
    k = 1 + (factor - 1) * ramp(t0, F.lit(frames))
    axis = F.lit("x") if axis is None else axis
    by = {a: F.when(axis == a, k).otherwise(1 / F.sqrt(k)) for a in XYZ}
    return changed(traj, late(who, t0), pz=reseated(F.col("radius") * by["z"], top), **{f"s{a}": F.col(f"s{a}") * by[a] for a in XYZ})


@edit
def retime(traj: DataFrame, who: Column, t0: Column, rate: float, frames: int = 3) -> DataFrame:
    """The body follows its own path at a rate that falls to ``rate`` over ``frames`` and stays there.

    Its source position is a running sum of rates; the pose is interpolated between the frames around it."""
    speed = F.when(late(who, t0), 1 + (rate - 1) * F.least(F.lit(1.0), (F.col("frame") - t0 + 1) / frames)).otherwise(F.lit(1.0))
    place = F.sum(F.when(F.col("frame") == 0, 0.0).otherwise(speed)).over(by_frame().rowsBetween(Window.unboundedPreceding, 0))
    t = traj.withColumn("u", place).withColumn("lo", F.floor("u").cast("int")).withColumn("hi", F.ceil("u").cast("int"))
    at = traj.select(*KEY, F.col("frame").alias("f"), "px", "py", "pz")
    t = t.join(at.select(*KEY, F.col("f").alias("lo"), *[F.col(f"p{a}").alias(f"lo{a}") for a in XYZ]), [*KEY, "lo"], "left")
    t = t.join(at.select(*KEY, F.col("f").alias("hi"), *[F.col(f"p{a}").alias(f"hi{a}") for a in XYZ]), [*KEY, "hi"], "left")
    lerp = {f"p{a}": F.col(f"lo{a}") + (F.coalesce(F.col(f"hi{a}"), F.col(f"lo{a}")) - F.col(f"lo{a}")) * (F.col("u") - F.col("lo")) for a in XYZ}
    return changed(t, late(who, t0), **lerp, **{f"w{a}": F.col(f"w{a}") * speed for a in XYZ}).select(*traj.columns)


@edit
def hover(traj: DataFrame, who: Column, t0: Column, radii: float, top: float = 0.0, frames: int = 3, still: Column | None = None) -> DataFrame:
    """Held at the height of t0 - 1, raised over ``frames`` where its clearance is less than ``radii``, without spin. Where ``still``
    holds it stays in its place, else it goes on sideways."""
    start, radius = at_frame("pz", t0 - 1), F.col("radius")
    lift = F.greatest(F.lit(0.0), radii * radius - F.greatest(F.lit(0.0), start - radius - top))
    place = {} if still is None else {c: F.when(still, at_frame(c, t0 - 1)).otherwise(F.col(c)) for c in ("px", "py")}
    return changed(traj, late(who, t0), pz=start + lift * ramp(t0, F.lit(frames)), **place, **{f"w{a}": F.lit(0.0) for a in XYZ})


@edit
def recolour(traj: DataFrame, who: Column, t0: Column, red: Column, green: Column, blue: Column, frames: int = 3) -> DataFrame:
    """The colour moves to a target along an eased ramp; ``recolour_target`` finds one at a wanted distance."""
    u = ramp(t0, F.lit(frames))
    return changed(traj, late(who, t0), **{c: F.col(c) + (x - F.col(c)) * u for c, x in (("cr", red), ("cg", green), ("cb", blue))})


@edit
def dip(traj: DataFrame, who: Column, t0: Column, t1: Column, depth: float, top: float = 0.0, fps: float = 12.0) -> DataFrame:
    """Sinks to ``depth`` radii under the surface by t1, with x and y at constant velocity."""
    u = (F.col("frame") - t0 + 1) / F.greatest(t1 - t0 + 1, F.lit(1))
    seconds = (F.col("frame") - (t0 - 1)) / fps
    z0 = at_frame("pz", t0 - 1)
    low = top + F.col("radius") * (1 - depth)
    inside = late(who, t0) & (F.col("frame") <= t1)
    return changed(traj, inside, px=at_frame("px", t0 - 1) + at_frame("vx", t0 - 1) * seconds, py=at_frame("py", t0 - 1) + at_frame("vy", t0 - 1) * seconds, pz=z0 + (low - z0) * smoothstep(u)).where(~(who & (F.col("frame") > t1)))


def without_pair(contacts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``contacts`` less those of a suppressed pair (clip_uid, one, other, s, e) inside its window, whichever body is named first."""
    both = pairs.select("clip_uid", F.explode(F.array(F.struct(F.col("one").alias("body_a"), F.col("other").alias("body_b")), F.struct(F.col("other").alias("body_a"), F.col("one").alias("body_b")))).alias("p"), "s", "e").select("clip_uid", "p.*", "s", "e")
    c, p = contacts.alias("c"), both.alias("p")
    same = (F.col("c.clip_uid") == F.col("p.clip_uid")) & (F.col("c.body_a") == F.col("p.body_a")) & (F.col("c.body_b") == F.col("p.body_b"))
    return c.join(p, same & (F.col("c.frame") >= F.col("p.s")) & (F.col("c.frame") <= F.col("p.e")), "left_anti")


@edit
def merge(traj: DataFrame, t0: Column, frames: Column, absorbed: Column, keeper_of: Column) -> DataFrame:
    """Absorbed bodies ease onto their keeper over ``frames`` and are then absent; keepers swell to twice the volume."""
    keeper = traj.select("clip_uid", "frame", F.col("body_id").alias("keeper"), *[F.col(f"p{a}").alias(f"k{a}") for a in XYZ])
    t = traj.withColumn("keeper", F.when(absorbed, keeper_of)).join(keeper, ["clip_uid", "frame", "keeper"], "left")
    partners = traj.where(absorbed).select("clip_uid", keeper_of.alias("body_id")).distinct().withColumn("is_keeper", F.lit(True))
    t = t.join(partners, ["clip_uid", "body_id"], "left")
    u, gone = ramp(t0, frames), F.col("frame") >= t0 + frames
    eaten = absorbed & F.col("kx").isNotNull() & (F.col("frame") >= t0)
    t = changed(t, eaten, **{f"p{a}": F.col(f"p{a}") + (F.col(f"k{a}") - F.col(f"p{a}")) * u for a in XYZ}, present=F.col("present") & ~gone)
    grown = F.coalesce(F.col("is_keeper"), F.lit(False)) & (F.col("frame") >= t0)
    k = 1 + (2.0 ** (1 / 3) - 1) * u
    return changed(t, grown, **{f"s{a}": F.col(f"s{a}") * k for a in XYZ}).select(*traj.columns)


@edit
def detach(traj: DataFrame, who: Column, t0: Column, radii: float, lx: float, ly: float, frames: int = 2) -> DataFrame:
    """The body slides across the light's direction, eased over ``frames``."""
    n = max((lx * lx + ly * ly) ** 0.5, 1e-9)
    far = radii * F.col("radius") * ramp(t0, F.lit(frames))
    return changed(traj, late(who, t0), px=F.col("px") - ly / n * far, py=F.col("py") + lx / n * far)


@edit
def invert(traj: DataFrame, who: Column, foot_x: Column, foot_y: Column, factor: float) -> DataFrame:
    """All clip long, scaled about the caster's foot point."""
    return changed(traj, who, px=foot_x + factor * (F.col("px") - foot_x), py=foot_y + factor * (F.col("py") - foot_y))


def resynced(traj: DataFrame, fps: float) -> DataFrame:
    """Velocities from the edited positions; the first frame takes the second's."""
    def v(a: str) -> Column:
        own = (F.col(f"p{a}") - F.lag(f"p{a}").over(by_frame())) * fps
        return F.coalesce(own, (F.lead(f"p{a}").over(by_frame()) - F.col(f"p{a}")) * fps, F.lit(0.0))

    return traj.withColumns({f"v{a}": v(a) for a in XYZ})


def label(clips: DataFrame, family: str, severity: str, t0: Column, frames: Column, culprit: Column) -> DataFrame:
    """One label row for each clip of an edit."""
    from lawtrace.operators.intervals import split_window

    return clips.select("clip_uid", F.lit(family).alias("family"), F.lit(severity).alias("severity_bin"), culprit.alias("culprit"), F.lit(float(STRENGTHS[family][severity])).alias("magnitude"), split_window(t0, F.col("frames"), frames).alias("w")).select("*", "w.*").drop("w")


def share_size(n: Column, fraction: Column) -> Column:
    """Members edited of a group of n: a rounded share, at least 2, of groups of four or more, else one."""
    return F.when(n >= 4, clip(F.bround(fraction * n), 2, 1e9).cast("int")).otherwise(1)
