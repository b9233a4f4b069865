"""Residuals of the motion laws: one row for each (clip, body, frame) and law, zero where the law holds.

All laws share one window over (clip, body) by frame, so a table clustered by clip is sorted once for all of them.
What a clip's plan says of a body (its surface, partner, pivot and so on) are columns: see ``CONTEXT``. Floats are
computed in double precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawtrace.functions.vectors import at_least, clip, cross, dot, lab_distance, norm, vec
from lawtrace.operators.geometry import unsupported

KEY = ("clip_uid", "body_id")


def by_frame():
    return Window.partitionBy(*KEY).orderBy("frame")


def whole():
    return Window.partitionBy(*KEY)

#: Columns of trajectories with the value an absent channel has.
OPTIONAL = {"present": True, "sx": 1.0, "sy": 1.0, "sz": 1.0, "cr": 0.0, "cg": 0.0, "cb": 0.0, "opacity": 1.0}
#: What other bodies of a frame show.
BODY = ("px", "py", "pz", "vx", "vy", "vz", "mass", "radius", "present")
NO_ID, NO_IDS = "cast(null as long)", "cast(array() as array<long>)"
#: What a plan may say of a body in its clip, with SQL for what holds where it says nothing. No bounds: the surface
#: is everywhere. No pivot: the body turns about itself. No arm: the mean distance from the pivot. No extent: the partner's radius.
CONTEXT = {
    "surface_top": "0D", **{c: "cast(null as double)" for c in ("cx", "cy", "hx", "hy", "partner_extent", "pivot_x", "pivot_y", "pivot_z", "arm")},
    "partner_id": NO_ID, "pass_through": "false", "contact_nx": "0D", "contact_ny": "0D", "contact_nz": "0D", "pair_ids": NO_IDS, "sibling_ids": "array(body_id)",
    "flight": "true", "contact_free": "true", "v_ref": "0D", "caster_id": NO_ID, "lx": "0D", "ly": "0D", "lz": "-1D", "step_tolerance": "1.6D", "free_fall_tol": "0.35D", "min_speed": "0.05D",
}
LAWS: dict[str, Callable[[float, float], Column]] = {}
READS: dict[str, tuple[str, ...]] = {}


def law(name: str, *reads: str):
    """Add a law: a function of (dt, |g|) giving a column over the prepared rows. It reads "forces" or "others", if named."""

    def add(f):
        LAWS[name], READS[name] = f, reads
        return f

    return add


def with_defaults(traj: DataFrame) -> DataFrame:
    """Missing and null optional channels take their defaults."""
    return traj.withColumns({c: F.coalesce(F.col(c), F.lit(v)) if c in traj.columns else F.lit(v) for c, v in OPTIONAL.items()})


def finite_difference(column: str, dt: float) -> Column:
    """Central inside, one-sided at both ends, zero for a single frame."""
    before, here, after = F.lag(column).over(by_frame()), F.col(column), F.lead(column).over(by_frame())
    return F.when(before.isNull() & after.isNull(), 0.0).when(before.isNull(), (after - here) / dt).when(after.isNull(), (here - before) / dt).otherwise((after - before) / (2 * dt))


def first(column: str) -> Column:
    return F.first_value(column).over(by_frame())


def step(column: str) -> Column:
    """Change since the frame before; zero on the first."""
    return F.coalesce(F.col(column) - F.lag(column).over(by_frame()), F.lit(0.0))


def contact_sides(contacts: DataFrame) -> DataFrame:
    """Two rows (clip_uid, body_id, frame, fx, fy, fz) for each contact: its force is minus the normal on body a and plus the normal on body b."""
    sides = F.explode(F.array(*[F.struct(F.col(b).alias("body_id"), *[(s * F.col(f"n{a}") * F.col("impulse")).alias(f"f{a}") for a in "xyz"]) for b, s in (("body_a", -1.0), ("body_b", 1.0))]))
    return contacts.select("clip_uid", "frame", sides.alias("e")).select("clip_uid", "frame", "e.*")


def prepared(traj: DataFrame, contacts: DataFrame, fps: float, ctx: dict[str, float | str], gravity: float = 9.81, names: tuple[str, ...] | None = None) -> DataFrame:
    """Rows with every column that the laws ``names`` read (all laws if not given).

    What a plan says of a body, the columns of ``CONTEXT``, comes from ``ctx`` (a number, or SQL over the row), else from
    a column of ``traj`` (see ``planned``), else from the default, which also stands for a null.

    Laws that read contacts or other bodies share one exchange by clip, which serves every window: contacts enter as
    rows of their own that a window adds up, and the other bodies of a frame are a list on each of its rows, as long as
    the clip has bodies. Rows are sorted twice: by frame for the lists, and by body for all the rest, when the lists are gone. Laws of a body's own motion need neither.
    """
    reads = {x for n in names or LAWS for x in READS[n]}
    t = with_defaults(traj)
    if "forces" in reads:
        t = t.withColumn("is_body", F.lit(True)).unionByName(contact_sides(contacts), allowMissingColumns=True)
    if reads:
        t = t.repartition("clip_uid")
    body = F.struct("body_id", *BODY)
    if "others" in reads:
        frame = Window.partitionBy("clip_uid", "frame").orderBy("body_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        t = t.withColumn("others", F.collect_list(F.when(F.col("is_body"), body) if "forces" in reads else body).over(frame))
    else:
        t = t.withColumn("others", F.array(body))
    t = t.withColumns({k: _context(t, ctx, k, default) for k, default in CONTEXT.items()})
    partner, caster = (F.get(F.filter("others", lambda o: o["body_id"] == F.col(c)), F.lit(0)) for c in ("partner_id", "caster_id"))
    t = t.withColumns({"partner": partner, "caster": caster, "pair": _members("pair_ids"), "group": _members("sibling_ids")}).withColumn("group_size", F.size("group"))
    dt, g = 1.0 / fps, gravity
    acc = {f"a{a}": finite_difference(f"v{a}", dt) for a in "xyz"}
    steps = {f"d{p}{a}": step(f"{p}{a}") for p in "pvw" for a in "xyz"}
    t = t.withColumn("speed", norm(vec("v"))).withColumn("volume", F.greatest(F.col("sx"), F.lit(1e-9)) * F.greatest(F.col("sy"), F.lit(1e-9)) * F.greatest(F.col("sz"), F.lit(1e-9)))
    size = [at_least(F.abs(c), 1e-9) for c in vec("s")]
    t = t.withColumn("ratio", F.greatest(*size) / F.least(*size)).withColumn("alpha", clip(F.col("opacity"), 0, 1))

    def energy(o: Column) -> Column:
        return 0.5 * o["mass"] * (o["vx"] * o["vx"] + o["vy"] * o["vy"] + o["vz"] * o["vz"]) + o["mass"] * g * (o["pz"] - F.col("surface_top"))

    own = energy(F.struct(*BODY))
    t = t.withColumn("pair_energy", F.when(F.size("pair") >= 2, F.aggregate("pair", F.lit(0.0), lambda x, o: x + energy(o))).otherwise(own))
    t = t.withColumn("siblings", F.size(F.filter("group", lambda o: o["present"])))
    arm = tuple(F.col(f"p{a}") - F.col(f"pivot_{a}") for a in "xyz")
    span = at_least(dot(arm, arm), 1e-12)
    t = t.withColumn("reach", F.sqrt(span)).withColumns(dict(zip(("tx", "ty", "tz"), (c / span for c in cross(arm, vec("v"))))))
    # here, as rows then have the order of the windows that follow and hold no lists
    if "forces" in reads:
        same = Window.partitionBy(*KEY, "frame")
        t = t.withColumns({f"f{a}": F.coalesce(F.sum(f"f{a}").over(same), F.lit(0.0)) for a in "xyz"} | {"touch": F.count("fx").over(same) > 0}).where("is_body")
    else:
        t = t.withColumns({f"f{a}": F.lit(0.0) for a in "xyz"} | {"touch": F.lit(False)})
    near = F.max("touch").over(by_frame().rowsBetween(-1, 1))
    firsts = {f"first_{c}": first(c) for c in ("volume", "alpha", "ratio", "siblings", "cr", "cg", "cb")}
    t = t.withColumns({**acc, **steps, **{f"dt{a}": step(f"t{a}") for a in "xyz"}, "speed_before": F.lag("speed").over(by_frame()), "energy_before": F.lag("pair_energy").over(by_frame()), "nth": F.row_number().over(by_frame()), "touching": near | ~F.col("contact_free"), "free": unsupported(F.col("surface_top"), fps), **firsts})
    t = t.withColumn("moved", norm(vec("dp")))
    seconds = (F.col("nth") - 1) * dt
    t = t.withColumn("seconds", seconds).withColumns({f"fit{a}": F.when(F.col("flight"), F.col(f"p{a}") - (0.0 if a != "z" else -0.5 * g) * seconds * seconds) for a in "xyz"})
    flying = F.when(F.col("flight"), F.col("seconds"))
    t = t.withColumns({"typical_move": F.median(F.when((F.col("nth") > 1) & (F.col("moved") > 1e-9), F.col("moved"))).over(whole()), "frames": F.count(flying).over(whole()), "mean_arm": F.avg("reach").over(whole()), "mt": F.avg(flying).over(whole()), **{f"mf{a}": F.avg(f"fit{a}").over(whole()) for a in "xyz"}})
    centred = F.when(F.col("flight"), F.col("seconds") - F.col("mt"))
    t = t.withColumns({"tt": F.sum(centred * centred).over(whole()), **{f"tf{a}": F.sum(centred * (F.col(f"fit{a}") - F.col(f"mf{a}"))).over(whole()) for a in "xyz"}})
    expected = F.when(F.col("v_ref") > 1e-6, F.col("v_ref") * dt).otherwise(F.col("typical_move"))
    lost = F.when((F.col("nth") > 1) & (expected > 1e-9), clip(1 - F.col("moved") / expected, 0, 1)).otherwise(0.0)
    return t.withColumn("lost", F.sum(lost).over(by_frame().rowsBetween(Window.unboundedPreceding, 0)))


def _context(t: DataFrame, ctx: dict[str, float | str], name: str, default: str) -> Column:
    if name in ctx:
        given = F.expr(ctx[name]) if isinstance(ctx[name], str) else F.lit(float(ctx[name]))
    elif name in t.columns:
        given = F.col(name)
    else:
        return F.expr(default)
    return F.coalesce(given, F.expr(default))


def _members(ids: str) -> Column:
    """The bodies of the frame that are listed in ``ids``."""
    return F.filter("others", lambda o: F.array_contains(F.col(ids), o["body_id"]))


def planned(traj: DataFrame, plans: DataFrame) -> DataFrame:
    """``traj`` with the columns of its bodies' plans (clip_uid, body_id, any of ``CONTEXT`` or what ``ctx`` reads)."""
    return traj.join(plans, list(KEY), "left")


def _free_error(g: float) -> Column:
    return norm((F.col("ax"), F.col("ay"), F.col("az") + g)) / g


@law("penetration", "others")
def penetration(dt, g):
    """How deep the body is in its partner along the contact normal, if it may pass through it, else how far its lowest
    point is under the surface, over the surface's bounds; in radii. A normal of no length is the vertical."""
    n = norm(vec("contact_n"))
    off = tuple(F.col(f"p{a}") - F.col("partner")[f"p{a}"] for a in "xyz")
    gap = F.abs(F.when(n > 1e-9, dot(off, vec("contact_n")) / n).otherwise(off[2]))
    overlap = at_least(F.col("radius") + F.coalesce("partner_extent", F.col("partner")["radius"]) - gap, 0)
    over = F.col("cx").isNull() | (F.abs(F.col("px") - F.col("cx")) <= F.col("hx") + F.col("radius")) & (F.abs(F.col("py") - F.col("cy")) <= F.col("hy") + F.col("radius"))
    depth = F.when(over, at_least(F.col("surface_top") - (F.col("pz") - F.col("radius")), 0)).otherwise(0.0)
    return F.when(F.col("pass_through") & F.col("partner").isNotNull(), overlap).otherwise(depth) / at_least(F.col("radius"), 1e-9)


@law("free_fall")
def free_fall(dt, g):
    """Missing from free fall, where the body is above its surface and not next to a bounce."""
    return _free_error(g) * F.col("free").cast("double")


@law("mass_continuity")
def mass_continuity(dt, g):
    return 1.0 - F.col("present").cast("double")


@law("position_continuity")
def position_continuity(dt, g):
    """A step no speed at either end explains."""
    reach = F.greatest("speed_before", "speed") * dt * F.col("step_tolerance")
    return F.when(F.col("nth") == 1, 0.0).otherwise(at_least(F.col("moved") - reach, 0) / F.col("radius"))


@law("linear_momentum", "forces")
def linear_momentum(dt, g):
    m = F.col("mass")
    rest = (m * F.col("dvx") - F.col("fx") * dt, m * F.col("dvy") - F.col("fy") * dt, m * F.col("dvz") - (F.col("fz") - m * g) * dt)
    return norm(rest) / (m * g * dt)


@law("energy_at_contact", "others")
def energy_at_contact(dt, g):
    """Gain of mechanical energy of the pair, or of the body where no two of a pair are there."""
    scale = F.greatest(F.col("energy_before"), F.col("mass") * g * F.col("radius"))
    return F.when(F.col("nth") == 1, 0.0).otherwise(at_least(F.col("pair_energy") - F.col("energy_before"), 0) / scale)


@law("trajectory_shape")
def trajectory_shape(dt, g):
    """Distance from the least-squares parabola of given gravity through the frames of flight, in radii; nothing outside them."""
    slope = {a: F.col(f"tf{a}") / F.col("tt") for a in "xyz"}
    off = tuple(F.col(f"fit{a}") - F.col(f"mf{a}") - slope[a] * (F.col("seconds") - F.col("mt")) for a in "xyz")
    return F.when((F.col("frames") < 3) | ~F.col("flight"), 0.0).otherwise(norm(off) / at_least(F.col("radius"), 1e-9))


@law("shape_continuity")
def shape_continuity(dt, g):
    return F.abs(F.col("volume") / F.col("first_volume") - 1)


@law("mass_dissolution")
def mass_dissolution(dt, g):
    return F.greatest(clip(1 - F.col("alpha") / at_least(F.col("first_alpha"), 1e-9), 0, 1), 1.0 - F.col("present").cast("double"))


@law("object_count", "others")
def object_count(dt, g):
    """Change of the number of bodies that are there of a declared group."""
    return F.when(F.col("group_size") == 0, 0.0).otherwise(F.abs(F.col("siblings") / at_least(F.col("first_siblings"), 1) - 1))


@law("colour_continuity")
def colour_continuity(dt, g):
    return lab_distance(vec("c", "rgb"), vec("first_c", "rgb"))


@law("shape_anisotropy")
def shape_anisotropy(dt, g):
    return F.abs(F.col("ratio") / F.col("first_ratio") - 1)


@law("angular_momentum", "forces")
def angular_momentum(dt, g):
    """Change of spin while free of contact, or of the turning about the pivot where there is one."""
    about = norm(vec("dt")) * F.coalesce("arm", "mean_arm")
    return F.when(F.col("pivot_x").isNotNull(), about).otherwise(norm(vec("dw")) * F.col("radius")) / (g * dt) * (~F.col("touching")).cast("double")


@law("support")
def support(dt, g):
    return F.when(_free_error(g) < F.col("free_fall_tol"), 0.0).otherwise(at_least(F.col("pz") - F.col("radius") - F.col("surface_top"), 0) / F.col("radius"))


@law("friction")
def friction(dt, g):
    along = dot((F.col("ax"), F.col("ay"), F.col("az") + g), vec("v")) / at_least(F.col("speed"), 1e-9)
    return F.when(F.col("speed") > F.col("min_speed"), F.abs(along) / g).otherwise(0.0)


@law("phase_consistency")
def phase_consistency(dt, g):
    """Frames of its own motion the body has lost so far."""
    return F.col("lost")


@law("shadow_consistency", "others")
def shadow_consistency(dt, g):
    """Distance of the body from its caster's projection along the light, in the caster's radii; nothing without a caster."""
    light = at_least(norm(vec("l")), 1e-9)
    l = [F.col(f"l{a}") / light for a in "xyz"]  # noqa: E741
    caster = F.col("caster")
    t = (caster["pz"] - F.col("surface_top")) / F.when(F.abs(l[2]) > 1e-6, -l[2]).otherwise(1e-6)
    miss = norm((F.col("px") - (caster["px"] + t * l[0]), F.col("py") - (caster["py"] + t * l[1])))
    return F.coalesce(miss / at_least(caster["radius"], 1e-9), F.lit(0.0))


def wide(traj: DataFrame, contacts: DataFrame, fps: float, ctx: dict[str, float | str], gravity: float = 9.81, names: tuple[str, ...] | None = None) -> DataFrame:
    """One column for each law."""
    rows = prepared(traj, contacts, fps, ctx, gravity, names)
    return rows.select("clip_uid", "body_id", "frame", *[f(1.0 / fps, gravity).alias(n) for n, f in LAWS.items() if names is None or n in names])


def long(traj: DataFrame, contacts: DataFrame, fps: float, ctx: dict[str, float | str], gravity: float = 9.81) -> DataFrame:
    """``(clip_uid, body_id, frame, law, r)``: every law of every body, by one unpivot of ``wide``."""
    return wide(traj, contacts, fps, ctx, gravity).unpivot(["clip_uid", "body_id", "frame"], list(LAWS), "law", "r")
