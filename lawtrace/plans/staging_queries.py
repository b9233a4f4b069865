"""Queries on supports, event contacts, candidate frames, hiding boxes and moving cameras."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawtrace.functions import vectors as V
from lawtrace.operators import geometry, staging
from lawtrace.plans import views
from lawtrace.plans.catalog import query, r, tidy
from lawtrace.plans.geometry_queries import ENDS, IMPACTS

TCB = views.sql_with("traj", "contacts", "bodies")
FLOOR = 0.2
#: By brute force: every body of the frame and every static one is compared with the point.
SUPPORT = f"""clip_frames as (select distinct clip_uid, frame from traj),
tops as (select c.clip_uid, c.frame, b.body_id, b.ord, b.box, b.x0, b.y0, b.hx, b.hy, b.z0 + case when b.box then b.hz else greatest(b.hx, b.hy, b.hz) end as top from bodies b join clip_frames c on c.clip_uid = b.clip_uid where b.static and not b.dormant
    union all select t.clip_uid, t.frame, b.body_id, b.ord, b.box, b.x0, b.y0, b.hx, b.hy, t.pz + t.radius from bodies b join traj t on t.clip_uid = b.clip_uid and t.body_id = b.body_id where not b.static and not b.dormant),
near_tops as (select t.clip_uid, t.body_id, t.frame, o.top, o.body_id as support_id, row_number() over (partition by t.clip_uid, t.body_id, t.frame order by o.top desc, o.ord) as k from traj t join tops o on o.clip_uid = t.clip_uid and o.frame = t.frame and o.body_id <> t.body_id
    where o.top <= t.pz - t.radius + 1e-3 and (not o.box or (abs(t.px - o.x0) <= o.hx + t.radius and abs(t.py - o.y0) <= o.hy + t.radius))),
below as (select * from near_tops where k = 1)"""


@query(f"{TCB}, {SUPPORT} select t.clip_uid, t.body_id, t.frame, {r(f'coalesce(top, {FLOOR})', 'support')}, support_id from traj t left join below b on b.clip_uid = t.clip_uid and b.body_id = t.body_id and b.frame = t.frame")
def support_moving(spark, sf_dir):
    """What lies under every body at every frame, bodies that move too."""
    t = views.traj(spark, sf_dir)
    points = t.select("clip_uid", "body_id", "frame", "px", "py", "pz", "radius")
    return tidy(staging.support_among(points, t, views.bodies(spark, sf_dir), FLOOR).select("clip_uid", "body_id", "frame", "support", "support_id"))


PAIRS = f"""{TCB}, z as (select clip_uid, max(frame) as last from traj group by 1),
c as (select k.clip_uid, k.frame, k.seq, k.body_a, k.body_b, a.ord = 3 or b.ord = 3 as liked from contacts k join bodies a on a.clip_uid = k.clip_uid and a.body_id = k.body_a join bodies b on b.clip_uid = k.clip_uid and b.body_id = k.body_b
    where k.frame >= 1 and k.body_a <> k.body_b and not a.static and not a.dormant and not b.static and not b.dormant),
met as (select a.clip_uid, a.body_id as body_a, b.body_id as body_b, min(a.frame) as meets from traj a join traj b on a.clip_uid = b.clip_uid and a.frame = b.frame and a.body_id <> b.body_id join z on z.clip_uid = a.clip_uid
    where a.frame >= 1 and a.frame < last and sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2) + power(a.pz - b.pz, 2)) <= 1.02e0 * (a.radius + b.radius) group by 1, 2, 3),
s as (select c.*, coalesce(meets, c.frame) as f from c left join met m on m.clip_uid = c.clip_uid and m.body_a = c.body_a and m.body_b = c.body_b),
v as (select s.*, sqrt(power(b.px - a.px, 2) + power(b.py - a.py, 2) + power(b.pz - a.pz, 2)) as size, (p.vx - q.vx) * (b.px - a.px) + (p.vy - q.vy) * (b.py - a.py) + (p.vz - q.vz) * (b.pz - a.pz) as along
    from s join traj a on a.clip_uid = s.clip_uid and a.frame = f and a.body_id = body_a join traj b on b.clip_uid = s.clip_uid and b.frame = f and b.body_id = body_b
    join traj p on p.clip_uid = s.clip_uid and p.frame = f - 1 and p.body_id = body_a join traj q on q.clip_uid = s.clip_uid and q.frame = f - 1 and q.body_id = body_b),
k as (select *, row_number() over (partition by clip_uid order by not liked, f, seq) as k from v where size <= 1e-9 or along / size >= 0.35e0)"""


@query(PAIRS + " select clip_uid, f as frame, body_a, body_b from k where k = 1")
def contact_first_pair(spark, sf_dir):
    """The first contact of two moving bodies, at the frame where their gap closes; the actor's win."""
    return staging.pair_contacts(views.contacts(spark, sf_dir), views.traj(spark, sf_dir), views.bodies(spark, sf_dir), F.col("ord") == 3)


@query(f"{TCB}, {ENDS} select b.clip_uid, b.body_id, coalesce(max(e.frame), -1) as frame from bodies b left join (select e.* from ends e join bodies o on o.clip_uid = e.clip_uid and o.body_id = e.other where not o.static and e.body_id <> e.other) e on e.clip_uid = b.clip_uid and e.body_id = b.body_id group by 1, 2")
def contact_last_dynamic(spark, sf_dir):
    return staging.last_dynamic_contacts(views.contacts(spark, sf_dir), views.bodies(spark, sf_dir))


EVENTS = f"""{TCB}, z as (select clip_uid, max(frame) + 1 as frames from traj group by 1), awake as (select k.* from contacts k where k.body_a % 15 in (1, 4, 7) and k.seq % 21 = 0 and not exists (select 1 from bodies b where b.dormant and b.clip_uid = k.clip_uid and b.body_id in (k.body_a, k.body_b))),
{ENDS.replace("from contacts", "from awake")}, {IMPACTS[len(ENDS) + 2:]},
actors as (select b.clip_uid, b.body_id, frames, cast(4 + b.ord as int) as t0 from bodies b join z on z.clip_uid = b.clip_uid where not b.static and not b.dormant),
riding as (select a.clip_uid, a.body_id, 1 as priority, a.t0 as frame, arg_min(o.body_id, o.ord) as partner_id, 1e0 as nz from actors a join traj t on t.clip_uid = a.clip_uid and t.body_id = a.body_id and t.frame = a.t0 join bodies o on o.clip_uid = a.clip_uid and o.static and not o.floor
    where t0 between 1 and frames - 3 and sqrt(power(greatest(abs(px - o.x0) - o.hx, 0), 2) + power(greatest(abs(py - o.y0) - o.hy, 0), 2) + power(greatest(abs(pz - o.z0) - o.hz, 0), 2)) <= 1.35e0 * t.radius group by a.clip_uid, a.body_id, a.t0),
struck as (select a.clip_uid, a.body_id, 2, i.frame, i.other, i.nz from actors a join impacts i on i.clip_uid = a.clip_uid and i.body_id = a.body_id where i.frame between 1 and frames - 3),
touched as (select clip_uid, body_id, 3, frame, other, 1e0 from (select a.clip_uid, a.body_id, frames, min(e.frame) as frame, arg_min(e.other, e.frame * 10000000000 + seq) as other from actors a join ends e on e.clip_uid = a.clip_uid and e.body_id = a.body_id group by 1, 2, 3) where frame between 1 and frames - 3),
{SUPPORT},
low as (select a.clip_uid, a.body_id, a.frames, b.support_id, min(t.frame) as first from actors a join below b on b.clip_uid = a.clip_uid and b.body_id = a.body_id and b.frame = 0 join traj t on t.clip_uid = a.clip_uid and t.body_id = a.body_id and t.pz - t.radius <= b.top + 1e-4 group by 1, 2, 3, 4),
resting as (select clip_uid, body_id, 4, case when first > 0 then first when frames // 3 between 1 and frames - 2 then cast(frames // 3 as int) end as frame, support_id, 1e0 from low),
ranked as (select *, row_number() over (partition by clip_uid, body_id order by priority, frame) as k from (select * from riding union all select * from struck union all select * from touched union all select * from resting) where frame is not null)
select r.clip_uid, r.body_id, priority, frame, partner_id, b.static or priority in (1, 4) as partner_static, {r('nz', 'nz')} from ranked r join bodies b on b.clip_uid = r.clip_uid and b.body_id = r.partner_id where k = 1"""


@query(EVENTS)
def contact_event(spark, sf_dir):
    """The contact to stage an event on for every body that moves, by four ranked relations. Only some bodies have recorded contacts."""
    b, t, c = views.bodies(spark, sf_dir), views.traj(spark, sf_dir), views.contacts(spark, sf_dir).where("body_a % 15 in (1, 4, 7) and seq % 21 = 0")
    actors = b.where("not static and not dormant").select("clip_uid", "body_id", (F.col("ord") + 4).cast("int").alias("t0"))
    return tidy(staging.event_contacts(actors, c, t, b, FLOOR).select("clip_uid", "body_id", "priority", "frame", "partner_id", "partner_static", "nz"))


@query(f"""{TCB}, {ENDS}, last as (select e.clip_uid, e.body_id, max(e.frame) as last from ends e join bodies o on o.clip_uid = e.clip_uid and o.body_id = e.other where not o.static and e.frame < 20 group by 1, 2),
s as (select t.clip_uid, t.body_id, t.frame, b.ord, t.radius, coalesce(last, -1) as last, sqrt(vx * vx + vy * vy + vz * vz) as speed, coalesce(sqrt(power(px - lag(px) over w, 2) + power(py - lag(py) over w, 2) + power(pz - lag(pz) over w, 2)), 0) as step
    from traj t join bodies b on b.clip_uid = t.clip_uid and b.body_id = t.body_id left join last l on l.clip_uid = t.clip_uid and l.body_id = t.body_id where not b.static and not b.dormant and b.ord < 8 and t.frame < 40 window w as (partition by t.clip_uid, t.body_id order by frame)),
a as (select *, sum(step) over (partition by clip_uid, body_id order by frame) as arc from s), e as (select *, max(case when frame = 35 then arc end) over (partition by clip_uid, body_id) as end_arc from a),
c as (select *, abs(frame - 14) + 3 * len(list_filter(range(frame, frame + 4), lambda q: q % 7 < 2 and q >= 9)) as cost from e where frame >= greatest(1, last + 1) and frame <= 35 and speed > 0.3 and end_arc - arc >= radius),
k as (select *, row_number() over (partition by clip_uid order by cost, ord, frame) as k from c) select clip_uid, body_id, frame, {r('speed', 'speed')}, cost from k where k = 1""")
def frame_candidate(spark, sf_dir):
    """The body and frame to hold for four frames of forty: near a third of the clip, in sight, moving, with path ahead."""
    b, c = views.bodies(spark, sf_dir), views.contacts(spark, sf_dir).where("frame < 20")
    rows = views.traj(spark, sf_dir).where("frame < 40").join(b.where("not static and not dormant and ord < 8").select("clip_uid", "body_id", "ord"), ["clip_uid", "body_id"])
    occluded = F.filter(F.sequence(F.lit(9), F.lit(39)), lambda q: q % 7 < 2)
    scenes = b.select("clip_uid").distinct().select("clip_uid", F.lit(40).alias("frames"), occluded.alias("occluded"))
    return tidy(staging.stall_frames(rows, scenes, staging.last_dynamic_contacts(c, b), 4))


_EYE = (5, -20, 6)
_near, _far = ([f"((b.{x}0 {s} b.h{x} - {e}) / (t.p{x} - {e}))" for x, e in zip("xyz", _EYE)] for s in "-+")
_in = "greatest(0, " + ", ".join(f"least({a}, {b})" for a, b in zip(_near, _far)) + ")"
_out = "least(1, " + ", ".join(f"greatest({a}, {b})" for a, b in zip(_near, _far)) + ")"


@query(f"{TCB} select t.clip_uid, t.body_id, t.frame, coalesce(bool_or({_in} <= {_out}) filter (where b.body_id is not null), false) as hidden from traj t left join bodies b on b.clip_uid = t.clip_uid and b.static and b.box and not b.floor and b.hz > least(b.hx, b.hy) and abs(b.q0) >= 0.999 and t.px <> 5 and t.pz <> 6 group by 1, 2, 3")
def camera_hidden_any(spark, sf_dir):
    """Bodies behind any upright static box of their clip."""
    t = views.traj(spark, sf_dir)
    eye = tuple(F.lit(float(e)) for e in _EYE)
    # the SQL divides by these two differences, so rows in line with the eye are left to the tests
    found = staging.hidden_behind(t.select("clip_uid", "body_id", "frame", "px", "py", "pz"), views.bodies(spark, sf_dir), eye)
    return found.select("clip_uid", "body_id", "frame", (F.col("hidden") & (F.col("px") != 5) & (F.col("pz") != 6)).alias("hidden"))


#: A third of the scenes stand still, a third go straight and a third orbit their aim (5, 5, 3) by an angle of their own.
SCENES = "select clip_uid, cast(max(frame) + 1 as int) as frames, case when clip_uid % 3 = 0 then 'static' when clip_uid % 3 = 1 then 'orbit' else 'push' end as motion, 5e0 as x0, -20e0 as y0, 6e0 as z0, 5e0 + 25e0 * sin((1 + clip_uid % 5) / 10e0) as x1, 5e0 - 25e0 * cos((1 + clip_uid % 5) / 10e0) as y1, 6e0 + clip_uid % 2 as z1, 5e0 as ax, 5e0 as ay, 3e0 as az from {traj} group by clip_uid"
_u, _w = "(x0 - ax) * (x1 - ax) + (y0 - ay) * (y1 - ay) + (z0 - az) * (z1 - az)", "sqrt(power({0}0 - ax, 2))"
POSES = f"""scenes as ({SCENES.format(traj="traj")}), bent as (select *, acos(({_u}) / (sqrt(power(x0 - ax, 2) + power(y0 - ay, 2) + power(z0 - az, 2)) * sqrt(power(x1 - ax, 2) + power(y1 - ay, 2) + power(z1 - az, 2)))) as turn from scenes),
poses as (select clip_uid, f::int as frame, {", ".join(f"case when motion = 'static' or f = 0 then {x}0 when motion = 'orbit' then a{x} + sin((1 - f / (frames - 1)::double) * turn) / sin(turn) * ({x}0 - a{x}) + sin(f / (frames - 1)::double * turn) / sin(turn) * ({x}1 - a{x}) else {x}0 + ({x}1 - {x}0) * f / (frames - 1)::double end as {x}" for x in "xyz")}, ax, ay, az from bent, unnest(range(frames)) as t(f))"""


@query(f"{TCB}, {POSES} select clip_uid, frame, {r('x', 'x')}, {r('y', 'y')}, {r('z', 'z')} from poses")
def camera_orbit(spark, sf_dir):
    scenes = spark.sql(SCENES, traj=views.traj(spark, sf_dir))
    return tidy(staging.camera_poses(scenes).select("clip_uid", "frame", "x", "y", "z"))


_len = "sqrt(power(ax - x, 2) + power(ay - y, 2) + power(az - z, 2))"
_flat = "sqrt(power(ax - x, 2) + power(ay - y, 2))"


@query(f"""{TCB}, {POSES}, d as (select t.clip_uid, t.body_id, t.frame, t.px - x as dx, t.py - y as dy, t.pz - z as dz, (ax - x) / {_len} as fx, (ay - y) / {_len} as fy, (az - z) / {_len} as fz, (ay - y) / {_flat} as rx, -(ax - x) / {_flat} as ry from traj t join poses p on p.clip_uid = t.clip_uid and p.frame = t.frame),
s as (select *, dx * fx + dy * fy + dz * fz as depth, dx * rx + dy * ry as right_, dx * (ry * fz) + dy * (-rx * fz) + dz * (rx * fy - ry * fx) as up from d)
select clip_uid, body_id, frame, depth > 1e-3 and abs(right_) <= 0.96e0 * 0.25e0 * depth and abs(up) <= 0.96e0 * 0.15e0 * depth as seen from s""")
def camera_in_view_moving(spark, sf_dir):
    """Bodies inside the view of their frame's camera."""
    t = views.traj(spark, sf_dir)
    poses = staging.camera_poses(spark.sql(SCENES, traj=t))
    seen = geometry.in_view(V.vec("p"), V.vec(""), V.vec("a"), 0.25, 0.15)
    return t.join(poses, ["clip_uid", "frame"]).select("clip_uid", "body_id", "frame", seen.alias("seen"))


OUTCOME = f"""{TCB}, s as (select c.clip_uid, c.seq, t.step, a.vx * nx + a.vy * ny + a.vz * nz as ua, b.vx * nx + b.vy * ny + b.vz * nz as ub from contacts c cross join (values (-1), (0), (1), (2), (3)) t(step)
    join traj a on a.clip_uid = c.clip_uid and a.body_id = c.body_a and a.frame = c.frame + t.step join traj b on b.clip_uid = c.clip_uid and b.body_id = c.body_b and b.frame = c.frame + t.step),
g as (select clip_uid, seq, max(ua) filter (where step = -1) as ua, max(ub) filter (where step = -1) as ub, arg_min(ub - ua, step) filter (where step >= 0 and ub - ua > 1e-3) as apart from s group by 1, 2),
e as (select *, case when abs(ua - ub) < 1e-6 then 0.5e0 else least(greatest(coalesce(apart, ub - ua) / (ua - ub), 0.05e0), 1) end as e from g where ua is not null and ub is not null),
m as (select e.*, a.mass * 5 as ma, b.mass as mb, c.nx, c.nz, a.vx as avx, b.vz as bvz from e join contacts c on c.clip_uid = e.clip_uid and c.seq = e.seq join traj a on a.clip_uid = c.clip_uid and a.body_id = c.body_a and a.frame = c.frame - 1 join traj b on b.clip_uid = c.clip_uid and b.body_id = c.body_b and b.frame = c.frame - 1),
o as (select *, (ma * ua + mb * ub + mb * e * (ub - ua)) / (ma + mb) as va, (ma * ua + mb * ub + ma * e * (ua - ub)) / (ma + mb) as vb from m)
select clip_uid, seq, {r('va', 'va')}, {r('vb', 'vb')}, {r('avx + (va - ua) * nx', 'a_x')}, {r('bvz + (vb - ub) * nz', 'b_z')} from o"""


@query(OUTCOME)
def contact_mass_ratio(spark, sf_dir):
    """The outcome of every contact, were its first body five times as heavy."""
    c, t = views.contacts(spark, sf_dir), views.traj(spark, sf_dir)
    return tidy(staging.mass_ratio_outcome(c, t, geometry.implied_restitution(c, t), F.lit(5.0)).select("clip_uid", "seq", "va", "vb", "a_x", "b_z"))


@query(f"""{TCB}, z as (select clip_uid, max(frame) as last from traj group by 1), p as (select a.clip_uid, a.body_id as body_a, b.body_id as body_b, 6 as t0 from bodies a join bodies b on a.clip_uid = b.clip_uid and a.ord = 3 and b.ord = case when a.clip_uid % 2 = 0 then 9 else 5 end),
o as (select p.clip_uid, p.t0, max(a.frame) as e from p join bodies q on q.clip_uid = p.clip_uid and q.body_id = p.body_b join traj a on a.clip_uid = p.clip_uid and a.body_id = p.body_a and a.frame >= p.t0 left join traj b on b.clip_uid = p.clip_uid and b.body_id = p.body_b and b.frame = a.frame
    where case when q.static then sqrt(power(greatest(abs(a.px - q.x0) - q.hx, 0), 2) + power(greatest(abs(a.py - q.y0) - q.hy, 0), 2) + power(greatest(abs(a.pz - q.z0) - q.hz, 0), 2)) < a.radius else sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2) + power(a.pz - b.pz, 2)) < a.radius + b.radius end group by 1, 2)
select o.clip_uid, t0 as s, least(e + 2, last) as e from o join z on z.clip_uid = o.clip_uid where least(e + 2, last) > t0""")
def overlap_end(spark, sf_dir):
    """The windows of a suppressed pair, a body and a wall or another body, as long as they overlap."""
    t, b = views.traj(spark, sf_dir), views.bodies(spark, sf_dir)
    a, o = (b.where(c).select("clip_uid", F.col("body_id").alias(n)) for c, n in (("ord = 3", "body_a"), ("ord = if(clip_uid % 2 = 0, 9, 5)", "body_b")))
    return staging.overlap_windows(t, a.join(o, "clip_uid").withColumn("t0", F.lit(6)), b)
