"""Queries on contacts, supports, cameras and frame choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawtrace.functions import vectors as V
from lawtrace.operators import edits, geometry
from lawtrace.plans import views
from lawtrace.plans.catalog import crc32_sql, query, r, tidy
from lawtrace.plans.motion import sized

TC = views.sql_with("traj", "contacts")
NEAR = f"""{TC}, near as (select a.clip_uid, a.frame, a.body_id as body_a, b.body_id as body_b, sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2) + power(a.pz - b.pz, 2)) as distance
    from traj a join traj b on a.clip_uid = b.clip_uid and a.frame = b.frame and a.body_id < b.body_id where a.present and b.present)"""


ROUND = f"{TC}, ball as (select *, radius * (sx + sy + sz) / 3 as r from traj where present)"


@query(ROUND + " select a.clip_uid, a.frame, a.body_id as body_a, b.body_id as body_b from ball a join ball b on a.clip_uid = b.clip_uid and a.frame = b.frame and a.body_id < b.body_id where sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2) + power(a.pz - b.pz, 2)) <= a.r + b.r + 0.02e0 union all select clip_uid, frame, body_id, null from ball where pz - r <= 0.6e0 + 0.02e0")
def contacts_geometric(spark, sf_dir):
    return geometry.contacts(views.traj(spark, sf_dir), 0.6, 0.02)


SURFACES = "surfaces as (select clip_uid, body_id % 15 as ord, avg(px) as cx, avg(py) as cy, 2e0 as hx, 2e0 as hy, min(pz) + (body_id % 4) as top from traj group by clip_uid, body_id)"


@query(f"{TC}, {SURFACES}, hits as (select t.clip_uid, t.body_id, t.frame, max(s.top) as top from traj t join surfaces s on s.clip_uid = t.clip_uid and abs(t.px - cx) <= hx + radius and abs(t.py - cy) <= hy + radius and top <= t.pz - radius + 1e-3 group by 1, 2, 3) select t.clip_uid, t.body_id, t.frame, {r('coalesce(h.top, 0)', 'support')} from traj t left join hits h on h.clip_uid = t.clip_uid and h.body_id = t.body_id and h.frame = t.frame")
def support_below(spark, sf_dir):
    t = views.traj(spark, sf_dir)
    s = t.groupBy("clip_uid", "body_id").agg(geometry.steady_mean("px").alias("cx"), geometry.steady_mean("py").alias("cy"), F.lit(2.0).alias("hx"), F.lit(2.0).alias("hy"), (F.min("pz") + F.first("body_id") % 4).alias("top")).withColumn("ord", F.col("body_id") % 15)
    points = t.withColumn("point", F.struct("body_id", "frame"))
    return tidy(geometry.support_below(points, s, 0.0).select("clip_uid", "body_id", "frame", "support"))


@query(f"{TC} select clip_uid, body_id, frame, case when abs(px - 5) <= 2 and abs(py - 4) <= 3 then 1.5e0 else 0e0 end as height from traj")
def height_under(spark, sf_dir):
    return views.traj(spark, sf_dir).select("clip_uid", "body_id", "frame", geometry.height_under(F.col("px"), F.col("py"), (5, 4, 2, 3), 1.5, 0.0).alias("height"))


# camera at (5, -20, 6) looking at (5, 5, 3): forward (0, 25, -3) / |.|, right (1, 0, 0), up (0, 3, 25) / |.|
VIEW = "(dy * 25 - dz * 3) / sqrt(634e0) > 1e-3 and abs(px - 5) <= 0.96e0 * 0.25e0 * ((dy * 25 - dz * 3) / sqrt(634e0)) and abs((dy * 3 + dz * 25) / sqrt(634e0)) <= 0.96e0 * 0.15e0 * ((dy * 25 - dz * 3) / sqrt(634e0))"
SEEN_SQL = f"{TC}, d as (select *, py + 20 as dy, pz - 6 as dz from traj), seen as (select *, {VIEW} as seen from d)"


def seen():
    return geometry.in_view(V.vec("p"), (F.lit(5.0), F.lit(-20.0), F.lit(6.0)), (F.lit(5.0), F.lit(5.0), F.lit(3.0)), 0.25, 0.15)


@query(SEEN_SQL + " select clip_uid, body_id, frame, seen from seen")
def camera_in_view(spark, sf_dir):
    return views.traj(spark, sf_dir).select("clip_uid", "body_id", "frame", seen().alias("seen"))


@query(SEEN_SQL + ", p as (select clip_uid, frame, count(*) filter (where present) as here, count(*) filter (where present and seen) as n from seen where frame >= 5 group by 1, 2) select clip_uid, count(*) filter (where n < 0.6e0 * here) as frames from p group by 1")
def camera_off_screen(spark, sf_dir):
    return geometry.off_screen_frames(views.traj(spark, sf_dir), seen(), F.lit(5))


_slab = "greatest(least((4 - 5) / nullif(px - 5, 0), (6.5e0 - 5) / nullif(px - 5, 0)), least((0 + 20) / (py + 20), (1 + 20) / (py + 20)), least((1 - 6) / nullif(pz - 6, 0), (4 - 6) / nullif(pz - 6, 0)), 0)"
_out = "least(greatest((4 - 5) / nullif(px - 5, 0), (6.5e0 - 5) / nullif(px - 5, 0)), greatest((0 + 20) / (py + 20), (1 + 20) / (py + 20)), greatest((1 - 6) / nullif(pz - 6, 0), (4 - 6) / nullif(pz - 6, 0)), 1)"


@query(f"{TC} select clip_uid, body_id, frame, (abs(pz - 6) >= 1e-12) and {_slab} <= {_out} and {_slab} < 1 as hidden from traj")
def camera_hidden(spark, sf_dir):
    lit = lambda *v: tuple(F.lit(float(x)) for x in v)
    return views.traj(spark, sf_dir).select("clip_uid", "body_id", "frame", geometry.hidden_by_box(lit(5, -20, 6), V.vec("p"), lit(4, 0, 1), lit(6.5, 1, 4)).alias("hidden"))


FREE = f"""{TC}, b as (select *, pz - radius - 1.5e0 as height, lag(vz) over (partition by body_id order by frame) as before, lag(pz - radius - 1.5e0) over (partition by body_id order by frame) as above from traj),
c as (select *, coalesce(before < -1e-3 and vz > 1e-3 and (height < greatest(0.05e0, abs(vz) / 12e0 * 1.5e0) or above < greatest(0.05e0, abs(before) / 12e0 * 1.5e0)), false) as bounce from b)
select clip_uid, body_id, frame, height > 1e-3 and (frame = 0 or max(bounce::int) over (partition by body_id order by frame rows between 1 preceding and 1 following) = 0) as free from c"""


@query(FREE)
def unsupported_frames(spark, sf_dir):
    t = views.traj(spark, sf_dir)
    return t.select("clip_uid", "body_id", "frame", geometry.unsupported(1.5, views.FPS).alias("free"))


ENDS = "ends as (select clip_uid, frame, seq, body_a as body_id, body_b as other, nx, ny, nz from contacts union all select clip_uid, frame, seq, body_b, body_a, nx, ny, nz from contacts)"


@query(f"{TC}, {ENDS}, s as (select *, sqrt(vx * vx + vy * vy + vz * vz) as speed from traj), d as (select *, sqrt(power(vx - lag(vx) over w, 2) + power(vy - lag(vy) over w, 2) + power(vz - lag(vz) over w + {views.GRAVITY} / 12, 2)) as dv, speed > lag(speed) over w as faster from s window w as (partition by body_id order by frame)) select clip_uid, body_id, frame from d where dv > 0.15 and faster and frame >= 4 and not exists (select 1 from ends e where e.clip_uid = d.clip_uid and e.body_id = d.body_id and abs(e.frame - d.frame) <= 2 and e.frame in (select frame from traj t where t.body_id = d.body_id))")
def uncaused_frames(spark, sf_dir):
    touching = views.contacts(spark, sf_dir).select("clip_uid", "frame", F.explode(F.array("body_a", "body_b")).alias("body_id"))
    return geometry.uncaused(views.traj(spark, sf_dir), touching, F.lit(4), views.FPS, views.GRAVITY)


@query(f"{TC}, {ENDS} select clip_uid, body_id, min(frame) as frame, arg_min(other, frame * 10000000000 + seq) as other from ends group by 1, 2")
def contact_first(spark, sf_dir):
    return geometry.first_contact(views.contacts(spark, sf_dir))


IMPACTS = f"""{ENDS}, impacts as (select e.clip_uid, e.body_id, min(e.frame) as frame, arg_min(other, e.frame * 10000000000 + seq) as other, arg_min(nx / sqrt(nx * nx + ny * ny + nz * nz), e.frame * 10000000000 + seq) as nx, arg_min(ny / sqrt(nx * nx + ny * ny + nz * nz), e.frame * 10000000000 + seq) as ny, arg_min(nz / sqrt(nx * nx + ny * ny + nz * nz), e.frame * 10000000000 + seq) as nz
    from ends e join traj t on t.clip_uid = e.clip_uid and t.body_id = e.body_id and t.frame = e.frame - 1 join (select clip_uid, max(frame) as last from traj group by 1) z on z.clip_uid = e.clip_uid
    where e.frame >= 1 and e.frame <= z.last and sqrt(vx * vx + vy * vy + vz * vz) >= 0.3 and abs(vx * nx + vy * ny + vz * nz) / sqrt(nx * nx + ny * ny + nz * nz) >= 0.3e0 * sqrt(vx * vx + vy * vy + vz * vz) group by 1, 2)"""


@query(f"{TC}, {IMPACTS} select clip_uid, body_id, frame, other, {r('nz', 'nz')} from impacts")
def contact_first_impact(spark, sf_dir):
    return tidy(geometry.first_impact(views.contacts(spark, sf_dir), views.traj(spark, sf_dir)).drop("nx", "ny"))


@query(f"{TC}, a as (select c.clip_uid, c.frame, c.seq, abs(vx * nx + vy * ny + vz * nz) as along from contacts c join traj t on t.clip_uid = c.clip_uid and t.frame = c.frame and t.body_id = c.body_a), k as (select *, row_number() over (partition by clip_uid, frame order by along desc, seq) as k from a) select clip_uid, frame, seq, {r('along', 'along')} from k where k = 1")
def contact_head_on(spark, sf_dir):
    return tidy(geometry.head_on_contact(views.contacts(spark, sf_dir), views.traj(spark, sf_dir)))


@query(f"{TC} select c.clip_uid, c.frame, c.seq, {r('sqrt(power(a.vx - coalesce(b.vx, 0), 2) + power(a.vy - coalesce(b.vy, 0), 2) + power(a.vz - coalesce(b.vz, 0), 2))', 'speed')} from contacts c join traj a on a.clip_uid = c.clip_uid and a.frame = c.frame - 1 and a.body_id = c.body_a left join traj b on b.clip_uid = c.clip_uid and b.frame = c.frame - 1 and b.body_id = c.body_b")
def contact_approach(spark, sf_dir):
    return tidy(geometry.approach_speed(views.contacts(spark, sf_dir), views.traj(spark, sf_dir)))


@query(f"{views.sql_with('traj', 'contacts', 'bodies')}, z as (select clip_uid, max(frame) + 1 as frames from traj group by 1) select c.clip_uid, min(c.frame) as frame from contacts c join bodies a on a.clip_uid = c.clip_uid and a.body_id = c.body_a join bodies b on b.clip_uid = c.clip_uid and b.body_id = c.body_b join z on z.clip_uid = c.clip_uid where c.frame >= 1 and c.frame < frames - 2 and ((a.ord < 5 and b.ord >= 5 and not b.static and not b.dormant) or (b.ord < 5 and a.ord >= 5 and not a.static and not a.dormant)) group by 1")
def contact_outside_group(spark, sf_dir):
    b = views.bodies(spark, sf_dir).select("clip_uid", "body_id", (F.col("ord") < 5).alias("inside"), ((F.col("ord") >= 5) & ~F.col("static") & ~F.col("dormant")).alias("outside"))
    frames = views.traj(spark, sf_dir).groupBy("clip_uid").agg((F.max("frame") + 1).alias("frames"))
    return geometry.first_outside_contact(views.contacts(spark, sf_dir), b, frames)


@query(f"{TC} select clip_uid, case when min(frame) - 1 >= 1 then min(frame) - 1 end as frame from traj where pz - radius <= 0.51e0 group by 1")
def landing_first(spark, sf_dir):
    return geometry.first_landing(views.traj(spark, sf_dir), 0.5)


MERGE = NEAR + ", t as (select clip_uid, max(frame) + 1 as frames from traj group by 1), cand as (select n.clip_uid, body_a, body_b, min(n.frame) as frame, arg_min(distance, n.frame) as gap from near n join t on t.clip_uid = n.clip_uid where distance <= 3.6e0 and n.frame >= 1 and n.frame < frames - 2 group by 1, 2, 3)"


@query(MERGE + f" select clip_uid, body_a, body_b, frame, {r('gap', 'gap')} from cand")
def merge_candidates(spark, sf_dir):
    return tidy(geometry.merge_candidates(sized(spark, sf_dir), 3.6, F.col("frames")))


@query()
def merge_pairs(spark, sf_dir):
    """Greedy disjoint pairs: sequential, so without SQL; tested against a loop."""
    return tidy(geometry.greedy_pairs(geometry.merge_candidates(sized(spark, sf_dir), 3.6, F.col("frames")), 4))


@query(f"{TC}, s as (select *, sqrt(vx * vx + vy * vy + vz * vz) as speed from traj), p as (select *, max(speed) over (partition by body_id) as peak, max(frame) over (partition by body_id) as last from s), k as (select *, row_number() over (partition by clip_uid, body_id order by abs(frame - 20), frame) k from p where speed >= 0.6e0 * peak and frame >= 1 and frame < last) select clip_uid, body_id, frame from k where k = 1")
def frame_fast(spark, sf_dir):
    return geometry.fast_frame(views.traj(spark, sf_dir), F.lit(20))


@query(f"""{TC}, h as (select *, not present or pz > 5 as hidden, count(*) over (partition by clip_uid, body_id) as frames from traj),
o as (select *, max(hidden::int) over (partition by clip_uid, body_id order by frame rows between current row and 2 following) as shut from h),
c as (select clip_uid, body_id, max(frames) as frames, max(hidden::int) as ever, arg_min(frame, abs(frame - 20) * 100000 + frame) filter (where shut = 0 and frame between 1 and frames - 2) as found from o group by 1, 2)
select clip_uid, body_id, cast(case when ever = 1 and found is not null then found when 20 < frames - 1 then 20 end as int) as frame from c""")
def frame_clear(spark, sf_dir):
    return geometry.clear_frame(views.traj(spark, sf_dir), F.lit(20), 3, ~F.col("present") | (F.col("pz") > 5))


@query(f"{TC}, o as (select clip_uid, body_id, max(frame) + 1 as frames, min(frame) filter (where not present) as a, max(frame) filter (where not present) as b from traj group by 1, 2), c as (select *, cast(coalesce(case when body_id % 2 = 0 then floor((a + b) / 2e0) end, round_even((0.35e0 + 0.1e0 * (2 * (body_id % 7) / 7e0 - 1)) * frames, 0)) as int) as chosen from o) select clip_uid, body_id, case when chosen >= 1 and chosen <= frames - 2 then chosen end as frame from c")
def frame_event(spark, sf_dir):
    o = views.traj(spark, sf_dir).groupBy("clip_uid", "body_id").agg((F.max("frame") + 1).alias("frames"), F.collect_list(F.when(~F.col("present") & (F.col("body_id") % 2 == 0), F.col("frame"))).alias("occluded"))
    return o.select("clip_uid", "body_id", geometry.event_frame(F.col("occluded"), F.col("frames"), F.col("body_id") % 7 / 7.0).alias("frame"))


@query(f"{TC}, s as (select clip_uid, cast(max(frame) + 1 as int) as frames, avg(px) as x1, clip_uid % 2 = 0 as still from traj group by clip_uid) select clip_uid, f::int as frame, {r('5 + (x1 - 5) * (case when still then 0 else f / greatest(frames - 1, 1)::double end)', 'x')} from s, unnest(range(frames)) as t(f)")
def camera_track(spark, sf_dir):
    s = views.traj(spark, sf_dir).groupBy("clip_uid").agg((F.max("frame") + 1).alias("frames"), F.avg("px").alias("x1"))
    s = s.withColumns({"x0": F.lit(5.0), "y0": F.lit(-20.0), "z0": F.lit(6.0), "y1": F.lit(-18.0), "z1": F.lit(6.0), "motion": F.when(F.col("clip_uid") % 2 == 0, "static").otherwise("push")})
    return tidy(geometry.camera_track(s).select("clip_uid", "frame", "x"))


_q = {"w": "qw", "x": "qx", "y": "qy", "z": "qz"}
_rate = "sqrt(wx * wx + wy * wy + wz * wz)"
_s = f"(case when {_rate} > 1e-12 then sin({_rate} * 0.25e0 / 2) / {_rate} else 0 end)"


@query(f"{TC} select clip_uid, body_id, frame, {r(f'cos({_rate} * 0.25e0 / 2) * qw - {_s} * (wx * qx + wy * qy + wz * qz)', 'qw')}, {r(f'cos({_rate} * 0.25e0 / 2) * qx + {_s} * (wx * qw + wy * qz - wz * qy)', 'qx')} from traj")
def quaternion_spin(spark, sf_dir):
    """Rotations after a quarter of a second at constant rate."""
    q = V.spun(V.vec("q", "wxyz"), V.vec("w"), F.lit(0.25))
    return tidy(views.traj(spark, sf_dir).select("clip_uid", "body_id", "frame", q[0].alias("qw"), q[1].alias("qx")))


_ramp = "least(greatest(1, round_even(0.5e0 * n / 2, 0)::int), greatest(ceil(n / 2e0) - 1, 0)::int)"


@query(f"{TC}, p as (select clip_uid, body_id, frame, cast(3 + body_id % 9 as int) as n from traj where frame < 3 + body_id % 9), q as (select *, {_ramp} as m from p) select clip_uid, body_id, frame, {r('1 + 1.5e0 * (case when m > 0 then least((frame + 1) / (m + 1e0), (n - frame) / (m + 1e0), 1) else 1 end)', 'v')} from q")
def pulse_shape(spark, sf_dir):
    t = views.traj(spark, sf_dir).withColumn("n", (3 + F.col("body_id") % 9).cast("int")).where("frame < n")
    return tidy(t.select("clip_uid", "body_id", "frame", geometry.pulse(F.col("n"), F.col("frame"), 2.5, 1.0, 0.5).alias("v")))


@query(f"{TC}, b as (select distinct clip_uid, body_id from traj) select clip_uid, body_id, {r(crc32_sql("clip_uid::varchar || '|' || body_id::varchar || '|teleport|weak'") + ' / 4294967296e0', 'u')} from b")
def keyed_draws(spark, sf_dir):
    """Draws by key alone: the same at any partitioning."""
    t = views.traj(spark, sf_dir).select("clip_uid", "body_id").distinct()
    return tidy(t.withColumn("u", edits.draw(F.col("clip_uid"), F.col("body_id"), salt="teleport|weak")))


@query(f"{TC}, n as (select clip_uid, count(distinct body_id) as n from traj group by 1) select clip_uid, n, case when n >= 4 then greatest(round_even(0.6e0 * n, 0)::int, 2) else 1 end as members from n")
def target_share(spark, sf_dir):
    n = views.traj(spark, sf_dir).groupBy("clip_uid").agg(F.countDistinct("body_id").alias("n"))
    return n.withColumn("members", edits.share_size(F.col("n"), F.lit(0.6)))


_al = "(3e0 + 20) / (py + 20)"


@query(f"{TC} select clip_uid, body_id, frame, py > 3 and abs(5 + {_al} * (px - 5) - 5) <= 4 - radius * {_al} and 6 + {_al} * (pz - 6) between 4 - 2.5e0 + radius * {_al} and 4 + 2.5e0 - radius * {_al} as hidden from traj")
def camera_screen(spark, sf_dir):
    t = views.traj(spark, sf_dir)
    return t.select("clip_uid", "body_id", "frame", geometry.behind_screen((5.0, -20.0, 6.0), (5.0, 3.0, 4.0), (4.0, 2.5), F.col("radius")).alias("hidden"))


@query(f"""{TC}, s as (select c.clip_uid, c.seq, t.step, a.vx * nx + a.vy * ny + a.vz * nz as ua, b.vx * nx + b.vy * ny + b.vz * nz as ub from contacts c cross join (values (-1), (0), (1), (2), (3)) t(step)
    join traj a on a.clip_uid = c.clip_uid and a.body_id = c.body_a and a.frame = c.frame + t.step join traj b on b.clip_uid = c.clip_uid and b.body_id = c.body_b and b.frame = c.frame + t.step),
g as (select clip_uid, seq, max(ua) filter (where step = -1) - max(ub) filter (where step = -1) as approach, arg_min(ub - ua, step) filter (where step >= 0 and ub - ua > 1e-3) as apart from s group by 1, 2)
select clip_uid, seq, {r('approach', 'approach')}, {r('case when abs(approach) < 1e-6 then 0.5e0 else least(greatest(coalesce(apart, -approach) / approach, 0.05e0), 1) end', 'restitution')} from g where approach is not null""")
def contact_restitution(spark, sf_dir):
    return tidy(geometry.implied_restitution(views.contacts(spark, sf_dir), views.traj(spark, sf_dir)))
