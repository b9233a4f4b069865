"""Queries on trajectories: laws, intervals, severity, twins and edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lawtrace.functions import vectors as V
from lawtrace.operators import edits, intervals, laws, severity, twins
from lawtrace.plans import views
from lawtrace.plans.catalog import query, r, tidy

_NEIGHBOUR, _BOTH = "body_id ^ 1L", "array(body_id, body_id ^ 1L)"
#: One plan for all bodies; the partner of each is its neighbour.
CTX = {"surface_top": 1.5, "cx": 5.0, "cy": 5.0, "hx": 3.0, "hy": 3.0, "lx": 0.3, "ly": 0.2, "lz": -1.0, "partner_id": _NEIGHBOUR, "caster_id": _NEIGHBOUR, "pair_ids": _BOTH, "sibling_ids": _BOTH}
#: What laws read of the plans in ``views.PLANS`` that is no column there.
PLANNED = {"pair_ids": "array_compact(array(body_id, pair_to))", "sibling_ids": "if(single, array(body_id), array(body_id, sibling))", "flight": "flight_from is null or frame between flight_from and flight_to", "contact_free": "(frame + body_id) % 4 <> 0"}
G, DT = views.GRAVITY, 1.0 / views.FPS


def by_clip():
    return Window.partitionBy("clip_uid")


def culprit():
    return F.col("body_id") % 15 == 3

BODY = "over (partition by clip_uid, body_id order by frame)"
ALL = "over (partition by clip_uid, body_id)"

_lab_sql = []
for prefix in ("c", "first_c"):
    for ch in "rgb":
        c = f"least(greatest({prefix}{ch}, 0e0), 1e0)"
        _lab_sql.append(f"case when {c} <= 0.04045e0 then {c} / 12.92e0 else power(({c} + 0.055e0) / 1.055e0, 2.4e0) end as l{prefix}{ch}")
_xyz_sql = [f"({m[0]}e0 * l{p}r + {m[1]}e0 * l{p}g + {m[2]}e0 * l{p}b) / {w}e0 as x{p}{i}" for p in ("c", "first_c") for i, (m, w) in enumerate(zip(V.SRGB_TO_XYZ, V.WHITE))]
_f_sql = [f"case when x{p}{i} > 0.008856e0 then cbrt(x{p}{i}) else 7.787e0 * x{p}{i} + 16e0 / 116e0 end as f{p}{i}" for p in ("c", "first_c") for i in range(3)]
_lab_distance = "sqrt(power(116 * (fc1 - ffirst_c1), 2) + power(500 * ((fc0 - fc1) - (ffirst_c0 - ffirst_c1)), 2) + power(200 * ((fc1 - fc2) - (ffirst_c1 - ffirst_c2)), 2)) / 100"

LAW_ROWS = f"""{views.sql_with("traj", "contacts")},
forces as (select clip_uid, body_id, frame, sum(fx) fx, sum(fy) fy, sum(fz) fz from (
    select clip_uid, body_a as body_id, frame, -nx * impulse fx, -ny * impulse fy, -nz * impulse fz from contacts
    union all select clip_uid, body_b, frame, nx * impulse, ny * impulse, nz * impulse from contacts) group by 1, 2, 3),
joined as (select t.*, f.fx is not null as touch, coalesce(f.fx, 0) fx, coalesce(f.fy, 0) fy, coalesce(f.fz, 0) fz, o.px ox, o.py oy, o.pz oz, o.radius oradius, o.present opresent,
        0.5e0 * t.mass * (t.vx * t.vx + t.vy * t.vy + t.vz * t.vz) + t.mass * {G} * (t.pz - 1.5e0) + coalesce(0.5e0 * o.mass * (o.vx * o.vx + o.vy * o.vy + o.vz * o.vz) + o.mass * {G} * (o.pz - 1.5e0), 0) as energy,
        t.present::int + coalesce(o.present::int, 0) as siblings, t.sx * t.sy * t.sz as volume, greatest(t.sx, t.sy, t.sz) / least(t.sx, t.sy, t.sz) as ratio,
        sqrt(t.vx * t.vx + t.vy * t.vy + t.vz * t.vz) as speed, greatest(t.px * t.px + t.py * t.py + (t.pz - 8) * (t.pz - 8), 1e-12) as span
    from traj t left join traj o on o.clip_uid = t.clip_uid and o.frame = t.frame and o.body_id = xor(t.body_id, 1)
    left join forces f on f.clip_uid = t.clip_uid and f.frame = t.frame and f.body_id = t.body_id),
turned as (select *, (py * vz - (pz - 8) * vy) / span tx, ((pz - 8) * vx - px * vz) / span ty, (px * vy - py * vx) / span tz, frame * {DT} as seconds from joined),
w as (select *, {", ".join(f"case when lag(v{a}) {BODY} is null and lead(v{a}) {BODY} is null then 0 when lag(v{a}) {BODY} is null then (lead(v{a}) {BODY} - v{a}) / {DT} when lead(v{a}) {BODY} is null then (v{a} - lag(v{a}) {BODY}) / {DT} else (lead(v{a}) {BODY} - lag(v{a}) {BODY}) / (2 * {DT}) end as a{a}" for a in "xyz")},
        {", ".join(f"coalesce({p}{a} - lag({p}{a}) {BODY}, 0) as d{p}{a}" for p in "pvwt" for a in "xyz")},
        lag(speed) {BODY} as speed_before, lag(energy) {BODY} as energy_before,
        max(touch::int) over (partition by clip_uid, body_id order by frame rows between 1 preceding and 1 following) = 1 as touching,
        {", ".join(f"first_value({c}) {BODY} as first_{c}" for c in ("volume", "opacity", "ratio", "siblings", "cr", "cg", "cb"))},
        count(*) {ALL} as frames, avg(sqrt(span)) {ALL} as mean_arm, avg(seconds) {ALL} as mt,
        avg(px) {ALL} as mfx, avg(py) {ALL} as mfy, avg(pz + 0.5e0 * {G} * seconds * seconds) {ALL} as mfz, pz + 0.5e0 * {G} * seconds * seconds as fitz from turned),
m as (select *, sqrt(dpx * dpx + dpy * dpy + dpz * dpz) as moved, sum((seconds - mt) * (seconds - mt)) {ALL} as tt, sum((seconds - mt) * (px - mfx)) {ALL} as tfx,
        sum((seconds - mt) * (py - mfy)) {ALL} as tfy, sum((seconds - mt) * (fitz - mfz)) {ALL} as tfz, {", ".join(_lab_sql)} from w),
l1 as (select *, median(case when frame > 0 and moved > 1e-9 then moved end) {ALL} as typical, {", ".join(_xyz_sql)} from m),
falls as (select *, pz - radius - 1.5e0 as height, lag(vz) {BODY} as vz_before, lag(pz - radius - 1.5e0) {BODY} as height_before from l1),
bounces as (select *, coalesce(vz_before < -1e-3 and vz > 1e-3 and (height < greatest(0.05e0, abs(vz) / 8) or height_before < greatest(0.05e0, abs(vz_before) / 8)), false) as bounce from falls),
l2 as (select *, {", ".join(_f_sql)}, height > 1e-3 and (frame = 0 or max(bounce::int) over (partition by clip_uid, body_id order by frame rows between 1 preceding and 1 following) = 0) as free, sum(case when frame > 0 and typical > 1e-9 then least(greatest(1 - moved / typical, 0), 1) else 0 end) over (partition by clip_uid, body_id order by frame rows unbounded preceding) as lost,
        sqrt(ax * ax + ay * ay + (az + {G}) * (az + {G})) / {G} as free_error from bounces)
"""
_T = "(oz - 1.5e0) / (1e0 / sqrt(1.13e0))"
LAW_SQL = {
    "penetration": "case when abs(px - 5) <= 3 + radius and abs(py - 5) <= 3 + radius then greatest(1.5e0 - (pz - radius), 0) else 0 end / radius",
    "free_fall": "case when free then free_error else 0 end",
    "mass_continuity": "1e0 - present::int",
    "position_continuity": f"case when frame = 0 then 0 else greatest(moved - greatest(speed_before, speed) * {DT} * 1.6e0, 0) / radius end",
    "linear_momentum": f"sqrt(power(mass * dvx - fx * {DT}, 2) + power(mass * dvy - fy * {DT}, 2) + power(mass * dvz - (fz - mass * {G}) * {DT}, 2)) / (mass * {G} * {DT})",
    "energy_at_contact": f"case when frame = 0 then 0 else greatest(energy - energy_before, 0) / greatest(energy_before, mass * {G} * radius) end",
    "trajectory_shape": "case when frames < 3 then 0 else sqrt(power(px - mfx - tfx / tt * (seconds - mt), 2) + power(py - mfy - tfy / tt * (seconds - mt), 2) + power(fitz - mfz - tfz / tt * (seconds - mt), 2)) / radius end",
    "shape_continuity": "abs(volume / first_volume - 1)",
    "mass_dissolution": "greatest(least(greatest(1 - opacity / first_opacity, 0), 1), 1e0 - present::int)",
    "object_count": "abs(siblings / greatest(first_siblings, 1) - 1)",
    "colour_continuity": _lab_distance,
    "shape_anisotropy": "abs(ratio / first_ratio - 1)",
    "angular_momentum": f"case when touching then 0 else sqrt(dwx * dwx + dwy * dwy + dwz * dwz) * radius / ({G} * {DT}) end",
    "support": "case when free_error < 0.35 then 0 else greatest(pz - radius - 1.5e0, 0) / radius end",
    "friction": f"case when speed > 0.05 then abs(ax * vx + ay * vy + (az + {G}) * vz) / speed / {G} else 0 end",
    "phase_consistency": "lost",
    "shadow_consistency": f"coalesce(sqrt(power(px - (ox + {_T} * 0.3e0 / sqrt(1.13e0)), 2) + power(py - (oy + {_T} * 0.2e0 / sqrt(1.13e0)), 2)) / oradius, 0)",
}


OTHER_CTX = {"pass_through": ("penetration", {"pass_through": "true"}), "pivot_momentum": ("angular_momentum", {"pivot_x": 0.0, "pivot_y": 0.0, "pivot_z": 8.0})}
OTHER_SQL = {
    "pass_through": f"case when oradius is null then {LAW_SQL['penetration']} else greatest(radius + oradius - abs(pz - oz), 0) / radius end",
    "pivot_momentum": f"case when touching then 0 else sqrt(dtx * dtx + dty * dty + dtz * dtz) * mean_arm / ({G} * {DT}) end",
}


def _register_law(name: str, law: str, ctx: dict, sql: str) -> None:
    @query(f"{LAW_ROWS} select clip_uid, body_id, frame, {r(sql, 'r')} from l2", name=f"law_{name}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = laws.wide(views.traj(spark, sf_dir), views.contacts(spark, sf_dir), views.FPS, ctx, G, (law,))
        return tidy(found.withColumnRenamed(law, "r"))


for _name, _sql in LAW_SQL.items():
    _register_law(_name, _name, CTX, _sql)
for _name, (_law, _more) in OTHER_CTX.items():
    _register_law(_name, _law, {**CTX, **_more}, OTHER_SQL[_name])


# ---- laws under the plan of each clip and body

PLAN_ROWS = f"""{views.sql_with("traj", "contacts", "plans")},
p0 as (select t.*, x.* exclude (clip_uid, body_id), frame * {DT} as s, sqrt(contact_nx * contact_nx + contact_ny * contact_ny + contact_nz * contact_nz) as nn, sqrt(lx * lx + ly * ly + lz * lz) as ll,
    0.5e0 * mass * (vx * vx + vy * vy + vz * vz) + mass * {G} * (pz - surface_top) as own, pz - radius - surface_top as height from traj t join plans x on t.clip_uid = x.clip_uid and t.body_id = x.body_id)"""
_ACC = ", ".join(f"case when lag(v{a}) {BODY} is null then (lead(v{a}) {BODY} - v{a}) / {DT} when lead(v{a}) {BODY} is null then (v{a} - lag(v{a}) {BODY}) / {DT} else (lead(v{a}) {BODY} - lag(v{a}) {BODY}) / (2 * {DT}) end as a{a}" for a in "xyz")
_FREE_ERROR = f"sqrt(ax * ax + ay * ay + (az + {G}) * (az + {G})) / {G}"
_OTHER = "p0 p left join traj o on o.clip_uid = p.clip_uid and o.frame = p.frame and o.body_id ="
_IN = "flight_from is null or frame between flight_from and flight_to"
_LIGHT = "(o.pz - surface_top) / (case when abs(lz / ll) > 1e-6 then -lz / ll else 1e-6 end)"
PLAN_SQL = {
    "penetration": f"""select p.clip_uid, p.body_id, p.frame, case when p.pass_through and o.radius is not null then greatest(0, p.radius + coalesce(partner_extent, o.radius)
        - abs(case when nn > 1e-9 then ((p.px - o.px) * contact_nx + (p.py - o.py) * contact_ny + (p.pz - o.pz) * contact_nz) / nn else p.pz - o.pz end))
        when cx is null or (abs(p.px - cx) <= hx + p.radius and abs(p.py - cy) <= hy + p.radius) then greatest(0, -height) else 0 end / p.radius as v from {_OTHER} partner_id""",
    "free_fall": f"""select clip_uid, body_id, frame, case when height > 1e-3 and (frame = 0 or not near) then {_FREE_ERROR} else 0 end as v from (select *, coalesce(greatest(lag(bounce::int) {BODY}, bounce::int, lead(bounce::int) {BODY}), 0) = 1 as near
        from (select *, {_ACC}, coalesce(lag(vz) {BODY} < -1e-3 and vz > 1e-3 and (height < greatest(0.05e0, abs(vz) / 8) or lag(height) {BODY} < greatest(0.05e0, abs(lag(vz) {BODY}) / 8)), false) as bounce from p0) as b) as n""",
    "energy_at_contact": f"""select clip_uid, body_id, frame, coalesce(greatest(0, e - lag(e) {BODY}) / greatest(lag(e) {BODY}, mass * {G} * radius), 0) as v from (select p.*, own + coalesce(0.5e0 * o.mass * (o.vx * o.vx + o.vy * o.vy + o.vz * o.vz) + o.mass * {G} * (o.pz - surface_top), 0) as e from {_OTHER} pair_to) as x""",
    "trajectory_shape": f"""select p.clip_uid, p.body_id, p.frame, case when ({_IN}) and n >= 3 then sqrt(power(px - bx - kx * s, 2) + power(py - by_ - ky * s, 2) + power(pz + {G / 2} * s * s - bz - kz * s, 2)) / radius else 0 end as v
        from p0 p left join (select body_id, count(*) as n, {", ".join(f"regr_slope({q}, s) as k{a}, regr_intercept({q}, s) as {b}" for a, b, q in (("x", "bx", "px"), ("y", "by_", "py"), ("z", "bz", f"pz + {G / 2} * s * s")))} from p0 where {_IN} group by 1) as fit on fit.body_id = p.body_id""".replace("4.905", "4.905e0"),
    "object_count": f"""select clip_uid, body_id, frame, abs(n / greatest(first_value(n) {BODY}, 1)::double - 1) as v from (select p.*, p.present::int + case when single then 0 else coalesce(o.present::int, 0) end as n from {_OTHER} sibling) as x""",
    "angular_momentum": f"""select clip_uid, body_id, frame, case when (frame + body_id) % 4 = 0 or exists (select 1 from contacts c where c.clip_uid = x.clip_uid and x.body_id in (c.body_a, c.body_b) and abs(c.frame - x.frame) <= 1 and c.frame <= x.last)
        then 0 when pivot_x is null then coalesce(sqrt(power(wx - lag(wx) {BODY}, 2) + power(wy - lag(wy) {BODY}, 2) + power(wz - lag(wz) {BODY}, 2)), 0) * radius / ({G} * {DT})
        else coalesce(sqrt(power(tx - lag(tx) {BODY}, 2) + power(ty - lag(ty) {BODY}, 2) + power(tz - lag(tz) {BODY}, 2)), 0) * coalesce(arm, avg(sqrt(q)) {ALL}) / ({G} * {DT}) end as v
        from (select *, (ry * vz - rz * vy) / q as tx, (rz * vx - rx * vz) / q as ty, (rx * vy - ry * vx) / q as tz from (select *, greatest(rx * rx + ry * ry + rz * rz, 1e-12) as q
            from (select *, px - pivot_x as rx, py - pivot_y as ry, pz - pivot_z as rz, max(frame) {ALL} as last from p0) as a) as b) as x""",
    "support": f"select clip_uid, body_id, frame, case when {_FREE_ERROR} < 0.35 then 0 else greatest(0, height) / radius end as v from (select *, {_ACC} from p0) as x",
    "phase_consistency": f"""select clip_uid, body_id, frame, sum(case when frame > 0 and ref > 1e-9 then least(greatest(1 - moved / ref, 0), 1) else 0 end) over (partition by clip_uid, body_id order by frame rows unbounded preceding) as v
        from (select *, case when v_ref > 1e-6 then v_ref * {DT} else median(case when moved > 1e-9 then moved end) {ALL} end as ref from (select *, coalesce(sqrt(power(px - lag(px) {BODY}, 2) + power(py - lag(py) {BODY}, 2) + power(pz - lag(pz) {BODY}, 2)), 0) as moved from p0) as m) as x""",
    "shadow_consistency": f"select p.clip_uid, p.body_id, p.frame, coalesce(sqrt(power(p.px - (o.px + {_LIGHT} * lx / ll), 2) + power(p.py - (o.py + {_LIGHT} * ly / ll), 2)) / o.radius, 0) as v from {_OTHER} caster_id",
}


def _register_planned(name: str) -> None:
    @query(f"{PLAN_ROWS} select clip_uid, body_id, frame, {r('v', 'r')} from ({PLAN_SQL[name]}) as found", name=f"planned_{name}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = laws.planned(views.traj(spark, sf_dir), views.plans(spark, sf_dir))
        return tidy(laws.wide(t, views.contacts(spark, sf_dir), views.FPS, PLANNED, G, (name,)).withColumnRenamed(name, "r"))


for _name in PLAN_SQL:
    _register_planned(_name)


@query(LAW_ROWS + ", lawful as (" + " union all ".join(f"select clip_uid, body_id, '{n}' as law, frame, {e} as r from l2" for n, e in LAW_SQL.items()) + ") select clip_uid, law, " + r("max(r)", "most") + ", " + r("avg(r)", "mean") + ", count(*) as n from lawful group by 1, 2")
def laws_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every law of every body in long form, summed up by clip."""
    rows = laws.long(views.traj(spark, sf_dir), views.contacts(spark, sf_dir), views.FPS, CTX, G)
    return tidy(rows.groupBy("clip_uid", "law").agg(F.max("r").alias("most"), F.avg("r").alias("mean"), F.count("*").alias("n")))


# ---- twins: the third body of each clip is teleported from 35 % of the clip on

TWIN_SQL = f"""{views.sql_with("traj")}, sized as (select *, max(frame) over (partition by clip_uid) + 1 as frames from traj),
timed as (select *, cast(floor(0.35e0 * frames) as int) as t_event from sized),
pairs as (select *, case when body_id % 15 = 3 and frame >= t_event then px + 4 * radius else px end as i_px from timed)"""


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = views.traj(spark, sf_dir).withColumn("frames", F.max("frame").over(by_clip()) + 1)
    return t.withColumn("t_event", F.floor(F.lit(0.35) * F.col("frames")).cast("int"))


def twin_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = sized(spark, sf_dir)
    return twins.aligned(valid, edits.teleport(valid, culprit(), F.col("t_event"), 4.0))


def culprits(pairs: DataFrame) -> DataFrame:
    return pairs.where(culprit()).select("clip_uid", "body_id").distinct()


@query(TWIN_SQL + " select clip_uid, body_id, frame, t_event, " + r("i_px - px", "dx") + " from pairs")
def twin_alignment(spark, sf_dir):
    return tidy(twin_pairs(spark, sf_dir).select("clip_uid", "body_id", "frame", "t_event", (F.col("i_px") - F.col("px")).alias("dx")))


@query(TWIN_SQL + """, late as (select *, case when body_id % 15 = 3 and frame >= t_event - 2 and frame >= 0 then opacity / 2 else opacity end as i_opacity from pairs),
bad as (select clip_uid, frame, abs(opacity - i_opacity) as diff from late where frame < t_event and abs(opacity - i_opacity) > 0),
worst as (select clip_uid, arg_max(frame, diff * 1000000 - frame / 1e9) as frame from bad group by 1),
c as (select clip_uid, bool_or(clip_uid % 3 = 1 and body_id % 15 = 9) as lost from traj group by 1)
select c.clip_uid, not lost and w.clip_uid is null as identical, case when lost then 'bodies' when w.clip_uid is not null then 'opacity' end as channel, case when not lost then w.frame end as frame from c left join worst w on c.clip_uid = w.clip_uid""")
def twin_prefix(spark, sf_dir):
    """A faulty edit that begins two frames before its event is reported with its channel and frame, a body that one side
    lacks before all else."""
    valid = sized(spark, sf_dir)
    early = culprit() & (F.col("frame") >= F.col("t_event") - 2)
    bad = edits.changed(valid, early, opacity=F.col("opacity") / 2).where("not (clip_uid % 3 = 1 and body_id % 15 = 9)")
    return twins.prefix_report(twins.aligned(valid, bad, "full")).select("clip_uid", "identical", "channel", "frame")


@query(TWIN_SQL + " select clip_uid, body_id, min(frame) as first_frame from pairs where abs(px - i_px) > 1e-3 group by 1, 2")
def twin_moved_bodies(spark, sf_dir):
    """The first frame at which each body downstream of the event departs."""
    return twins.moved_bodies(twin_pairs(spark, sf_dir))


@query(TWIN_SQL + " select distinct clip_uid, frame from pairs where body_id % 15 = 3 and frame >= t_event and abs(px - i_px) > 1e-3")
def twin_diverged_frames(spark, sf_dir):
    p = twin_pairs(spark, sf_dir)
    return twins.diverged_frames(p, culprits(p))


DISTURBED_SQL = TWIN_SQL + ", bumped as (select *, case when body_id % 15 = 5 and frame >= t_event + 3 then i_px + 0.2e0 else i_px end as j_px from pairs)"


@query(DISTURBED_SQL + " select clip_uid, body_id, min(frame) as first_frame from bumped where abs(px - j_px) > 1e-3 and body_id % 15 <> 3 group by 1, 2")
def twin_disturbed(spark, sf_dir):
    p = twin_pairs(spark, sf_dir)
    bumped = p.withColumn("i_px", F.when((F.col("body_id") % 15 == 5) & (F.col("frame") >= F.col("t_event") + 3), F.col("i_px") + 0.2).otherwise(F.col("i_px")))
    return twins.disturbed(bumped, culprits(p))


@query(TWIN_SQL + " select clip_uid, bool_or(abs(px - i_px) > 1e-9) as changed from pairs where body_id % 15 = 3 group by 1")
def twin_dynamics_changed(spark, sf_dir):
    p = twin_pairs(spark, sf_dir)
    return twins.dynamics_changed(p, culprits(p))


@query(TWIN_SQL + " select clip_uid, body_id from pairs where body_id % 15 = 7 group by 1, 2 having bool_or(frame >= t_event)")
def twin_undeclared_change(spark, sf_dir):
    valid = sized(spark, sf_dir)
    both = edits.changed(edits.teleport(valid, culprit(), F.col("t_event"), 4.0), edits.late(F.col("body_id") % 15 == 7, F.col("t_event")), opacity=F.col("opacity") * 0.5)
    p = twins.aligned(valid, both)
    return twins.undeclared(p, culprits(p))


@query(TWIN_SQL + " select clip_uid from pairs group by 1 having clip_uid % 3 = 1 or not bool_or(body_id % 15 = 3 and frame >= t_event)")
def twin_unchanged(spark, sf_dir):
    """Pairs that an edit of two clips of three leaves as they were."""
    valid = sized(spark, sf_dir)
    return twins.unchanged(twins.aligned(valid, edits.teleport(valid, culprit() & (F.col("clip_uid") % 3 != 1), F.col("t_event"), 4.0)))


SPLICE_SQL = TWIN_SQL + " select clip_uid, body_id, frame, " + r("i_px", "px") + ", " + r("pz", "pz") + " from pairs"


@query(SPLICE_SQL)
def twin_splice(spark, sf_dir):
    valid = sized(spark, sf_dir)
    tail = edits.teleport(valid, culprit(), F.lit(0), 4.0).where(F.col("frame") >= F.col("t_event"))
    return tidy(twins.spliced(valid, tail, "t_event").select("clip_uid", "body_id", "frame", "px", "pz"))


# ---- severity

RESID_SQL = "select l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_extendedprice / 1000e0 as r from lineitem"
FLOOR_SQL = f"""with resid as ({RESID_SQL}), mu as (select l_returnflag, l_linestatus, median(r) as mu from resid group by 1, 2),
off as (select x.l_returnflag, x.l_linestatus, mu, 1.4826e0 * median(abs(r - mu)) as sigma, count(r) as n from resid x join mu using (l_returnflag, l_linestatus) group by 1, 2, 3),
floors as (select *, greatest(sigma, 1e-3) as sigma_eff from off)"""


def _resid(spark, sf_dir):
    return views.table(spark, sf_dir, "lineitem").selectExpr("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_extendedprice / 1000e0 as r")


@query(FLOOR_SQL + f" select l_returnflag, l_linestatus, {r('mu', 'mu')}, {r('sigma', 'sigma')}, {r('sigma_eff', 'sigma_eff')}, n from floors")
def noise_floor(spark, sf_dir):
    return tidy(severity.noise_floor(_resid(spark, sf_dir), ["l_returnflag", "l_linestatus"]))


@query(FLOOR_SQL + f""" select l_orderkey, l_linenumber, {r('(r - mu) / sigma_eff', 'z')}, {r('least(greatest((r - mu) / greatest(60 - mu, 1e-9), 0), 1)', 'score')}
from resid join floors using (l_returnflag, l_linestatus)""")
def noise_scores(spark, sf_dir):
    rows = _resid(spark, sf_dir)
    floors = F.broadcast(severity.noise_floor(rows, ["l_returnflag", "l_linestatus"]))  # one row for each of a few groups
    scored = rows.join(floors, ["l_returnflag", "l_linestatus"])
    return tidy(scored.select("l_orderkey", "l_linenumber", severity.z_score(F.col("r")).alias("z"), severity.score_against_floor(F.col("r"), F.col("mu"), F.lit(60.0)).alias("score")))


SCORED_SQL = TWIN_SQL + f""", d as (select *, coalesce(sqrt(power(px - lag(px) {BODY}, 2) + power(py - lag(py) {BODY}, 2) + power(pz - lag(pz) {BODY}, 2)), 0) as moved,
    coalesce(sqrt(power(i_px - lag(i_px) {BODY}, 2) + power(py - lag(py) {BODY}, 2) + power(pz - lag(pz) {BODY}, 2)), 0) as i_moved, sqrt(vx * vx + vy * vy + vz * vz) as speed from pairs),
res as (select *, case when frame = 0 then 0 else greatest(moved - greatest(lag(speed) {BODY}, speed) * {DT} * 1.6e0, 0) / radius end as twin, case when frame = 0 then 0 else greatest(i_moved - greatest(lag(speed) {BODY}, speed) * {DT} * 1.6e0, 0) / radius end as r from d),
scored as (select clip_uid, body_id, frame, frames, t_event, r, twin, least(greatest(abs(r - twin) / 9e0, 0), 1) as score from res)"""


def scored_rows(spark, sf_dir):
    """Continuity residuals of the culprit against the lawful twin."""
    valid = sized(spark, sf_dir).where(culprit())
    c = views.contacts(spark, sf_dir)
    bad = edits.teleport(valid, culprit(), F.col("t_event"), 4.0)
    a = laws.wide(valid, c, views.FPS, CTX, G, ("position_continuity",)).withColumnRenamed("position_continuity", "twin")
    b = laws.wide(bad, c, views.FPS, CTX, G, ("position_continuity",)).withColumnRenamed("position_continuity", "r")
    return b.join(a, twins.KEY).withColumn("score", severity.score_against_twin(F.col("r"), F.col("twin"), F.lit(9.0)))


FLAGSHIP_SQL = SCORED_SQL + f"""select clip_uid, body_id, {r('max(score)', 'peak')}, arg_max(frame, round(score, 9) * 1000000 - frame) as peak_frame, {r('arg_max(r, round(score, 9) * 1000000 - frame)', 'r')},
    list(frame order by frame) filter (where score > 0.05) as hot from scored where body_id % 15 = 3 group by 1, 2"""


@query(FLAGSHIP_SQL)
def teleport_severity(spark, sf_dir):
    """Is each culprit's motion consistent with its speed, how badly not and when, against its twin?"""
    rows = scored_rows(spark, sf_dir).withColumn("rank", F.round("score", 9))
    hot = F.array_sort(F.collect_list(F.when(F.col("score") > 0.05, F.col("frame"))))
    top = severity.peak(rows, ["clip_uid", "body_id"], "rank", carry=("r",), more=(hot.alias("hot"),))
    return tidy(top.select("clip_uid", "body_id", "peak", "peak_frame", "r", F.when(F.size("hot") > 0, F.col("hot")).alias("hot")))
