"""Queries on intervals of frames, edits and energy."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawtrace.operators import edits, energy, intervals
from lawtrace.plans import motion, views
from lawtrace.plans.catalog import query, r, tidy
from lawtrace.plans.motion import BODY, TWIN_SQL, culprit, sized

KEY = ["clip_uid", "body_id"]
ABSENT = f"""{views.sql_with("traj")}, flags as (select clip_uid, body_id, frame, not present as gone from traj),
runs as (select clip_uid, body_id, min(frame) as s, max(frame) as e from (select *, frame - row_number() over (partition by clip_uid, body_id order by frame) as g from flags where gone) group by clip_uid, body_id, g)"""


def gone(spark, sf_dir):
    return views.traj(spark, sf_dir).select(*KEY, "frame", (~F.col("present")).alias("gone"))


@query(ABSENT + " select * from runs")
def interval_islands(spark, sf_dir):
    return intervals.islands(gone(spark, sf_dir), KEY, "gone")


@query(ABSENT + " select clip_uid, body_id, to_json(list({s: s, e: e} order by s))::varchar as windows from runs group by 1, 2")
def interval_windows(spark, sf_dir):
    return intervals.as_windows(gone(spark, sf_dir), KEY, "gone").withColumn("windows", F.to_json("windows"))


@query(ABSENT + " select clip_uid, body_id, frame, gone as active from flags")
def interval_rasterised(spark, sf_dir):
    """Runs laid back on frames give the flags they came from."""
    rows = gone(spark, sf_dir)
    return intervals.rasterised(rows.drop("gone"), intervals.islands(rows, KEY, "gone"), KEY).select(*KEY, "frame", "active")


@query(ABSENT + ", n as (select *, e - s + 1 as len, row_number() over (partition by clip_uid, body_id order by e - s desc, s) as k from runs) select clip_uid, body_id, s, e, len from n where k = 1")
def interval_longest(spark, sf_dir):
    return intervals.longest_run(gone(spark, sf_dir), KEY, "gone")


@query(ABSENT + ", n as (select *, e - s + 1 as len, row_number() over (partition by clip_uid, body_id order by e - s desc, s) as k from runs where e > s) select clip_uid, body_id, s, e, len from n where k = 1")
def interval_longest_of_two(spark, sf_dir):
    """The longest run of at least two frames."""
    return intervals.longest_run(gone(spark, sf_dir), KEY, "gone", least=2)


@query(ABSENT + ", airborne as (select clip_uid, body_id, frame, pz - radius > 3e0 as up from traj), n as (select clip_uid, body_id, min(frame) s, max(frame) e from (select *, frame - row_number() over (partition by clip_uid, body_id order by frame) g from airborne where up) group by clip_uid, body_id, g), k as (select *, e - s + 1 as len, row_number() over (partition by clip_uid, body_id order by e - s desc, s) k from n) select clip_uid, body_id, s, e, len from k where k = 1")
def interval_airborne(spark, sf_dir):
    t = views.traj(spark, sf_dir).withColumn("up", F.col("pz") - F.col("radius") > 3.0)
    return intervals.longest_run(t, KEY, "up")


@query(ABSENT + " select clip_uid, body_id, frame, max(gone::int) over (partition by clip_uid, body_id order by frame rows between 2 preceding and 2 following) = 1 as wide from flags")
def interval_widened(spark, sf_dir):
    return gone(spark, sf_dir).withColumn("wide", intervals.widened(F.col("gone"), KEY, 2)).select(*KEY, "frame", "wide")


ATTRIBUTED_SQL = f"""{views.sql_with("traj")}, rows as (select clip_uid, body_id, frame, (body_id * 7 + frame * 13) % 11 / 10e0 as score, cast(floor(frame / 4) as int) % 2 = 1 as active, (frame * 5 + body_id) % 7 < 2 as observable from traj),
runs as (select clip_uid, body_id, min(frame) as s, max(frame) as e from (select *, frame - row_number() over (partition by clip_uid, body_id order by frame) as g from rows where active) group by clip_uid, body_id, g),
nexts as (select *, lead(s) over (partition by clip_uid, body_id order by s) as nxt from runs),
inside as (select x.clip_uid, x.body_id, x.frame, max(y.score) as placed from rows x join runs w on x.clip_uid = w.clip_uid and x.body_id = w.body_id and x.frame between w.s and w.e
    join rows y on y.clip_uid = x.clip_uid and y.body_id = x.body_id and y.frame between w.s and x.frame
        and y.frame > coalesce((select max(z.frame) from rows z where z.clip_uid = x.clip_uid and z.body_id = x.body_id and z.observable and z.frame between w.s and x.frame - 1), -1)
    where x.observable group by 1, 2, 3),
unseen as (select w.* from nexts w where not exists (select 1 from rows x where x.clip_uid = w.clip_uid and x.body_id = w.body_id and x.observable and x.frame between w.s and w.e)),
spilled as (select w.clip_uid, w.body_id, min(x.frame) as frame, (select max(y.score) from rows y where y.clip_uid = w.clip_uid and y.body_id = w.body_id and y.frame between w.s and w.e) as placed
    from unseen w join rows x on x.clip_uid = w.clip_uid and x.body_id = w.body_id and x.observable and x.frame > w.e and x.frame < coalesce(w.nxt, 1000000000) group by w.clip_uid, w.body_id, w.s, w.e),
both_ways as (select * from inside union all select * from spilled)
select rows.clip_uid, rows.body_id, rows.frame, b.placed is not null as gate, {r("coalesce(b.placed, 0)", "placed")} from rows left join both_ways b on rows.clip_uid = b.clip_uid and rows.body_id = b.body_id and rows.frame = b.frame"""


@query(ATTRIBUTED_SQL)
def severity_to_evidence(spark, sf_dir):
    rows = views.traj(spark, sf_dir).selectExpr("clip_uid", "body_id", "frame", "(body_id * 7 + frame * 13) % 11 / 10e0 as score", "cast(floor(frame / 4) as int) % 2 = 1 as active", "(frame * 5 + body_id) % 7 < 2 as observable")
    return tidy(intervals.attributed(rows, KEY).select(*KEY, "frame", "gate", "placed"))


GAIN_SQL = f"""{views.sql_with("traj")}, s as (select *, sqrt(vx * vx + vy * vy + vz * vz) as speed from traj where body_id % 15 in (3, 4)), one as (select clip_uid, frame, frame > 0 and speed > 1.05e0 * lag(speed) {BODY} + 1e-3 as gain from s),
f as (select clip_uid, frame, bool_or(coalesce(gain, false)) as gain, cast(floor(0.35e0 * (max(frame) over (partition by clip_uid) + 1)) as int) as t0, max(frame) over (partition by clip_uid) as last from one group by clip_uid, frame),
i as (select clip_uid, last, min(frame) s, max(frame) e from (select *, frame - row_number() over (partition by clip_uid order by frame) g from f where gain and frame >= t0) group by clip_uid, last, g),
c as (select clip_uid, s, least(last, s + 2 * cast(ceil((e - s + 1) / 2e0) as int) - 1) as e from i union all select distinct clip_uid, t0, least(t0 + 1, last) from f),
m as (select *, max(e) over (partition by clip_uid order by s, e rows between unbounded preceding and 1 preceding) as before from c),
g as (select *, sum(case when before is null or s > before + 1 then 1 else 0 end) over (partition by clip_uid order by s, e) as g from m)
select clip_uid, min(s) as s, cast(max(e) as int) as e from g group by clip_uid, g"""


@query(GAIN_SQL)
def interval_gain_windows(spark, sf_dir):
    """Frames from the event on in which either of two targets gains speed."""
    by = motion.laws.by_frame()
    t = views.traj(spark, sf_dir).where("body_id % 15 in (3, 4)").withColumn("speed", F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy") + F.col("vz") * F.col("vz")))
    t = t.withColumn("gain", F.coalesce(F.col("speed") > 1.05 * F.lag("speed").over(by) + 1e-3, F.lit(False)))
    frames = t.groupBy("clip_uid", "frame").agg(F.max("gain").alias("gain"))
    frames = frames.withColumn("t0", F.floor(0.35 * (F.max("frame").over(motion.by_clip()) + 1)).cast("int"))
    return intervals.gain_windows(frames, ["clip_uid"], "gain")


@query(TWIN_SQL + """ select distinct clip_uid, t_event as start, least(frames - 1, t_event + greatest(1, cast(round_even(0.5e0 * 12, 0) as int)) - 1) as intervention_end, frames - 1 as last from pairs""")
def interval_split(spark, sf_dir):
    c = sized(spark, sf_dir).select("clip_uid", "t_event", "frames").distinct()
    w = intervals.split_window(F.col("t_event"), F.col("frames"), intervals.frames_for(F.lit(0.5), views.FPS))
    return c.select("clip_uid", w.alias("w")).selectExpr("clip_uid", "w.violation.s as start", "w.intervention.e as intervention_end", "w.consequence.e as last")


@query(ABSENT + """, p as (select *, max(gone::int) over (partition by clip_uid, body_id order by frame rows between 1 preceding and 1 preceding) = 1 as late from flags)
select clip_uid, body_id, min(frame) filter (where late) - min(frame) filter (where gone) as latency, round(count(*) filter (where gone and late) / nullif(count(*) filter (where gone or late), 0), 6) + 0e0 as iou from p group by 1, 2""")
def detection_latency(spark, sf_dir):
    """Predictions that come one frame late, against the truth."""
    rows = gone(spark, sf_dir).withColumn("late", F.coalesce(F.lag("gone").over(motion.laws.by_frame()), F.lit(False)))
    return tidy(rows.groupBy(*KEY).agg(*intervals.overlap("gone", "late")))


# ---- edits

LATE = "body_id % 15 = 3 and frame >= t_event"


def _edited(sql_columns: dict[str, str], spark_edit, columns: tuple[str, ...], base: str = "timed"):
    picked = ", ".join(r(sql_columns.get(c, c), c) if c not in ("present",) else f"{sql_columns.get(c, c)} as {c}" for c in columns)

    @query(f"{TWIN_SQL.split(', pairs as')[0]} select clip_uid, body_id, frame, {picked} from {base}", name=f"edit_{spark_edit.__name__}")
    def run(spark, sf_dir):
        return tidy(spark_edit(sized(spark, sf_dir)).select(*KEY, "frame", *columns))

    return run


def _at(c: str, frame: str) -> str:
    return f"max(case when frame = {frame} then {c} end) over (partition by clip_uid, body_id)"


def _ramp(frames: str, start: str = "t_event") -> str:
    u = f"least(greatest((frame - {start} + 1) / ({frames}), 0e0), 1e0)"
    return f"({u} * {u} * (3 - 2 * {u}))"


def t_event():
    return F.col("t_event")


def teleport(t):
    return edits.teleport(t, culprit(), t_event(), 9.0)


def halt(t):
    return edits.halt(t, culprit(), t_event())


def wiggle(t):
    return edits.wiggle(t, culprit(), t_event(), t_event() + 12, 1.5, top=1.0)


def drop_out(t):
    return edits.drop_out(t, culprit(), t_event(), t_event() + 5)


def resize(t):
    factor = edits.resize_factor(2.3, F.col("clip_uid") % 2 == 0)
    return edits.resize(t, culprit(), t_event(), factor, top=1.5)


def fade(t):
    return edits.fade(t, culprit(), t_event(), F.lit(4))


def squash(t):
    return edits.squash(t, culprit(), t_event(), 2.8, axis=F.element_at(F.array(*map(F.lit, "xyz")), (F.col("clip_uid") % 3 + 1).cast("int")), top=1.5)


def hover(t):
    return edits.hover(t, culprit(), t_event(), 3.6, top=1.5, still=F.col("clip_uid") % 2 == 0)


def recolour(t):
    return edits.recolour(t, culprit(), t_event(), F.lit(1.0), F.lit(0.0), F.lit(0.5))


def detach(t):
    return edits.detach(t, culprit(), t_event(), 5.5, 0.3, 0.2)


def invert(t):
    return edits.invert(t, culprit(), F.lit(2.0), F.lit(1.0), -0.4)


def resync(t):
    return edits.resynced(edits.teleport(t, culprit(), t_event(), 4.0), views.FPS)


_edited({"px": f"case when {LATE} then px + 9 * radius else px end"}, teleport, ("px",))
_edited({c: f"case when {LATE} then {_at(c, 't_event - 1')} else {c} end" for c in ("px", "qw")} | {c: f"case when {LATE} then 0 else {c} end" for c in ("vx", "wz")}, halt, ("px", "qw", "vx", "wz"))
_u = "((frame - t_event) / 12e0)"
_edited({"py": f"case when {LATE} and frame <= t_event + 12 then py + sin(2 * pi() * 1.75e0 * {_u}) * power(sin(pi() * {_u}), 2) * 1.5e0 * radius else py end", "pz": f"case when {LATE} and frame <= t_event + 12 then greatest(pz, 1 + radius) else pz end"}, wiggle, ("py", "pz"))
_edited({"present": f"case when {LATE} and frame <= t_event + 5 then false else present end", "px": f"case when {LATE} and frame <= t_event + 5 then {_at('px', 't_event')} else px end"}, drop_out, ("present", "px"))
_k = f"(1 + (case when clip_uid % 2 = 0 then 1.3e0 else 1 / 2.3e0 - 1 end) * {_ramp('6e0')})"
_seat = "1.5e0 + {} + greatest(0, pz - radius - 1.5e0)"
_edited({"sx": f"case when {LATE} then sx * {_k} else sx end", "pz": f"case when {LATE} then {_seat.format(f'radius * {_k}')} else pz end"}, resize, ("sx", "pz"))
_edited({"opacity": f"case when {LATE} then opacity * (1 - {_ramp('4e0')}) else opacity end", "present": f"case when {LATE} then present and frame < t_event + 4 else present end"}, fade, ("opacity", "present"))
_k2 = f"(1 + 1.8e0 * {_ramp('6e0')})"
_by = [f"(case when clip_uid % 3 = {i} then {_k2} else 1 / sqrt({_k2}) end)" for i in range(3)]
_edited({f"s{a}": f"case when {LATE} then s{a} * {k} else s{a} end" for a, k in zip("xyz", _by)} | {"pz": f"case when {LATE} then {_seat.format(f'radius * {_by[2]}')} else pz end"}, squash, ("sx", "sy", "sz", "pz"))
_z0 = _at("pz", "t_event - 1")
_edited({"px": f"case when {LATE} and clip_uid % 2 = 0 then {_at('px', 't_event - 1')} else px end", "pz": f"case when {LATE} then {_z0} + greatest(0, 3.6e0 * radius - greatest(0, {_z0} - radius - 1.5e0)) * {_ramp('3e0')} else pz end", "wx": f"case when {LATE} then 0 else wx end"}, hover, ("px", "pz", "wx"))
_edited({"cr": f"case when {LATE} then cr + (1 - cr) * {_ramp('3e0')} else cr end", "cb": f"case when {LATE} then cb + (0.5e0 - cb) * {_ramp('3e0')} else cb end"}, recolour, ("cr", "cb"))
_edited({"px": f"case when {LATE} then px - 0.2e0 / sqrt(0.13e0) * 5.5e0 * radius * {_ramp('2e0')} else px end", "py": f"case when {LATE} then py + 0.3e0 / sqrt(0.13e0) * 5.5e0 * radius * {_ramp('2e0')} else py end"}, detach, ("px", "py"))
_edited({"px": "case when body_id % 15 = 3 then 2 - 0.4e0 * (px - 2) else px end", "py": "case when body_id % 15 = 3 then 1 - 0.4e0 * (py - 1) else py end"}, invert, ("px", "py"))
_moved = f"(case when {LATE} then px + 2 else px end)"
_edited({"vx": f"coalesce(({_moved} - lag({_moved}) {BODY}) * 12, (lead({_moved}) {BODY} - {_moved}) * 12, 0)"}, resync, ("vx",))


@query(f"""{TWIN_SQL} select p.clip_uid, p.body_id, p.frame, {r('coalesce(s.px, p.px)', 'px')}, {r('coalesce(s.vz, p.vz)', 'vz')} from pairs p
left join pairs s on p.body_id % 15 = 3 and p.frame >= p.t_event and s.clip_uid = p.clip_uid and s.body_id = p.body_id and s.frame = greatest(p.t_event, p.frame - 5)""")
def edit_time_slip(spark, sf_dir):
    return tidy(edits.time_slip(sized(spark, sf_dir), culprit(), t_event(), F.lit(5)).select(*KEY, "frame", "px", "vz"))


_rate = "case when body_id % 15 = 3 and frame >= t_event then 1 - 0.72e0 * least(1e0, (frame - t_event + 1) / 3e0) else 1e0 end"


@query(f"""{TWIN_SQL}, u as (select *, sum(case when frame = 0 then 0e0 else {_rate} end) over (partition by clip_uid, body_id order by frame rows unbounded preceding) as u from timed)
select u.clip_uid, u.body_id, u.frame, {r('case when u.body_id % 15 = 3 and u.frame >= u.t_event then a.px + (coalesce(b.px, a.px) - a.px) * (u.u - floor(u.u)) else u.px end', 'px')} from u
left join timed a on a.clip_uid = u.clip_uid and a.body_id = u.body_id and a.frame = cast(floor(u.u) as int) left join timed b on b.clip_uid = u.clip_uid and b.body_id = u.body_id and b.frame = cast(ceil(u.u) as int)""")
def edit_retime(spark, sf_dir):
    return tidy(edits.retime(sized(spark, sf_dir), culprit(), t_event(), 0.28).select(*KEY, "frame", "px"))


@query(f"""{TWIN_SQL}, z as (select *, {_at('px', 't_event - 1')} x0, {_at('vx', 't_event - 1')} v0, {_at('pz', 't_event - 1')} z0 from timed)
select clip_uid, body_id, frame, {r('case when ' + LATE + ' then x0 + v0 * (frame - (t_event - 1)) / 12e0 else px end', 'px')}, {r('case when ' + LATE + ' then z0 + (radius * 0.2e0 - z0) * ' + _ramp('9e0') + ' else pz end', 'pz')} from z where not (body_id % 15 = 3 and frame > t_event + 8)""")
def edit_dip(spark, sf_dir):
    return tidy(edits.dip(sized(spark, sf_dir), culprit(), t_event(), t_event() + 8, 0.8).select(*KEY, "frame", "px", "pz"))


@query(f"""{TWIN_SQL}, k as (select t.*, o.px as kx from timed t left join timed o on t.body_id % 15 = 4 and o.clip_uid = t.clip_uid and o.frame = t.frame and o.body_id = t.body_id - 1),
q as (select distinct clip_uid, body_id - 1 as body_id from timed where body_id % 15 = 4)
select k.clip_uid, k.body_id, k.frame, {r('case when kx is not null and k.frame >= t_event then px + (kx - px) * ' + _ramp('6e0').replace('frame', 'k.frame') + ' else px end', 'px')},
    {r('case when q.body_id is not null and k.frame >= t_event then sx * (1 + (power(2, 1 / 3e0) - 1) * ' + _ramp('6e0').replace('frame', 'k.frame') + ') else sx end', 'sx')},
    case when kx is not null and k.frame >= t_event then present and k.frame < t_event + 6 else present end as present
from k left join q on k.clip_uid = q.clip_uid and k.body_id = q.body_id""")
def edit_merge(spark, sf_dir):
    t = sized(spark, sf_dir)
    return tidy(edits.merge(t, t_event(), F.lit(6), F.col("body_id") % 15 == 4, F.col("body_id") - 1).select(*KEY, "frame", "px", "sx", "present"))


@query(TWIN_SQL + " select distinct clip_uid, 'teleport' as family, 'strong' as severity_bin, clip_uid * 15 + 3 as culprit, 9e0 as magnitude, t_event as t_event, frames - 1 as t_end from pairs")
def edit_label(spark, sf_dir):
    c = sized(spark, sf_dir).select("clip_uid", "t_event", "frames").distinct()
    found = edits.label(c, "teleport", "strong", t_event(), F.lit(1), F.col("clip_uid") * 15 + 3)
    return found.selectExpr("clip_uid", "family", "severity_bin", "culprit", "magnitude", "violation.s as t_event", "violation.e as t_end")


# ---- energy

_N = "sqrt(qw * qw + qx * qx + qy * qy + qz * qz)"
ENERGY_SQL = f"""{views.sql_with("traj", "contacts")}, unit as (select *, qw / {_N} as a, qx / {_N} as b, qy / {_N} as c, qz / {_N} as d, mass * sx * sy * sz as m from traj),
turned as (select *, (1 - 2 * (c * c + d * d)) * wx + 2 * (b * c + a * d) * wy + 2 * (b * d - a * c) * wz as ox, 2 * (b * c - a * d) * wx + (1 - 2 * (b * b + d * d)) * wy + 2 * (c * d + a * b) * wz as oy,
        2 * (b * d + a * c) * wx + 2 * (c * d - a * b) * wy + (1 - 2 * (b * b + c * c)) * wz as oz,
        case kind when 'sphere' then 0.4e0 * 0.25e0 when 'cube' then 0.5e0 / 3 else 7 * 0.25e0 / 12 end as ia, case kind when 'sphere' then 0.4e0 * 0.25e0 when 'cube' then 0.5e0 / 3 else 0.5e0 * 0.25e0 end as ic from unit),
b as (select *, 0.5e0 * m * (vx * vx + vy * vy + vz * vz) * present::int as kt, 0.5e0 * m * (ia * sx * sx * ox * ox + ia * sy * sy * oy * oy + ic * sz * sz * oz * oz) * present::int as kr, m * {views.GRAVITY} * pz * present::int as pe from turned),
e as (select *, kt + kr as ke, kt + kr + pe as energy from b),
x as (select *, coalesce(lag(energy) {BODY}, energy) as be, coalesce(lag(ke) {BODY}, ke) as bk, coalesce(lag(pe) {BODY}, pe) as bp, coalesce(lag(present) {BODY}, present) as bpres from e),
s as (select clip_uid, frame, sum(energy) total, sum(kt) kt, sum(kr) kr, sum(pe) pe, sum(case when present and abs(px - 5) < 4 then energy else 0 end) as visible, bool_and(present and abs(px - 5) < 4) as all_seen, sum(greatest(-(energy - be) - (bk + case when bpres and present then greatest(bp - pe, 0) else 0 end), 0)) as excess from x group by 1, 2),
touched as (select distinct clip_uid, frame from contacts),
n as (select s.*, max((t.frame is not null)::int) over (partition by s.clip_uid order by s.frame range between 1 preceding and 1 following) = 1 as near, first_value(total) over (partition by s.clip_uid order by s.frame) as first, coalesce(total - lag(total) over (partition by s.clip_uid order by s.frame), 0) as step from s left join touched t on s.clip_uid = t.clip_uid and s.frame = t.frame),
tr as (select clip_uid, frame, total, kt, kr, pe, visible, all_seen, first - total as dissipated, case when near then 0 else abs(step) / greatest(abs(first), 1e-9) end as free_anomaly, case when near then greatest(step, 0) / greatest(abs(first), 1e-9) else 0 end as contact_anomaly, excess / greatest(abs(first), 1e-9) as excess_loss from n)
"""


def seen():
    return F.abs(F.col("px") - 5) < 4


@query(ENERGY_SQL + f"select clip_uid, body_id, frame, {r('m * vx * present::int', 'momx', 7)}, {r('m * ia * sx * sx * ox * present::int', 'angx', 7)}, {r('m * ic * sz * sz * oz * present::int', 'angz', 7)}, {r('ke', 'kinetic', 7)}, {r('pe', 'potential', 7)}, {r('energy', 'energy', 7)} from e")
def energy_by_body(spark, sf_dir):
    return tidy(energy.by_body(views.traj(spark, sf_dir), views.GRAVITY).select(*KEY, "frame", "momx", "angx", "angz", "kinetic", "potential", "energy"), 7)


@query(ENERGY_SQL + f"select clip_uid, frame, {r('total', 'total', 3)}, {r('kt', 'kinetic_t', 3)}, {r('kr', 'kinetic_r', 3)}, {r('pe', 'potential', 3)}, {r('visible', 'total_in_frame', 3)}, all_seen, {r('dissipated', 'dissipated', 3)}, {r('free_anomaly', 'free_anomaly', 5)}, {r('contact_anomaly', 'contact_anomaly', 5)}, {r('excess_loss', 'excess_loss', 5)} from tr")
def energy_trace(spark, sf_dir):
    t = energy.trace(energy.by_body(views.traj(spark, sf_dir), views.GRAVITY), views.contacts(spark, sf_dir), seen())
    some = ("total", "kinetic_t", "kinetic_r", "potential", "total_in_frame", "dissipated")
    return t.select("clip_uid", "frame", "all_seen", *[(F.round(c, 3 if c in some else 5) + F.lit(0.0)).alias(c) for c in (*some, "free_anomaly", "contact_anomaly", "excess_loss")])


@query(ENERGY_SQL + f"select clip_uid, {r('arg_min(total, frame)', 'first', 3)}, {r('arg_max(total, frame)', 'last', 3)}, {r('arg_min(total, frame) - arg_max(total, frame)', 'dissipated', 3)}, {r('max(free_anomaly)', 'peak_free_anomaly', 3)}, {r('max(contact_anomaly)', 'peak_contact_anomaly', 3)}, {r('max(excess_loss)', 'peak_excess_loss', 3)}, {r('(arg_min(total, frame) - arg_max(total, frame)) / greatest(abs(arg_min(total, frame)), 1e-9)', 'fraction', 3)}, count(*) filter (where all_seen) as frames_all_seen from tr group by 1")
def energy_summary(spark, sf_dir):
    t = energy.trace(energy.by_body(views.traj(spark, sf_dir), views.GRAVITY), views.contacts(spark, sf_dir), seen())
    return tidy(energy.summary(t), 3)


@query(ENERGY_SQL + f""", own as (select distinct clip_uid, frame, body_a as body_id from contacts union select distinct clip_uid, frame, body_b from contacts),
q as (select e.*, max(frame) over (partition by e.clip_uid, e.body_id) as last, abs(coalesce(energy - lag(energy) over (partition by e.clip_uid, e.body_id order by e.frame), 0)) as change from e),
z as (select clip_uid, greatest(abs(sum(energy)), 1e-9) as scale from e where frame = 0 group by 1)
select q.clip_uid, q.body_id, q.frame, {r('case when exists (select 1 from own o where o.clip_uid = q.clip_uid and o.body_id = q.body_id and o.frame <= q.last and (abs(o.frame - q.frame) <= 1 or (q.frame = 0 and o.frame = q.last) or (q.frame = q.last and o.frame = 0))) then 0 else change / scale end', 'r', 5)} from q join z on q.clip_uid = z.clip_uid""")
def law_energy_balance(spark, sf_dir):
    b = energy.by_body(views.traj(spark, sf_dir), views.GRAVITY).withColumn("last", F.max("frame").over(motion.laws.whole()))
    return tidy(energy.free_anomaly(b, views.contacts(spark, sf_dir), F.col("last")), 5)


@query(ENERGY_SQL + "select clip_uid, frame, round(sum(energy) - sum(kt + kr + pe), 6) + 0e0 as gap from e group by 1, 2")
def energy_consistency(spark, sf_dir):
    """Energy recomputed from the body-state table agrees with the trace."""
    b = energy.by_body(views.traj(spark, sf_dir), views.GRAVITY)
    t = energy.trace(b, views.contacts(spark, sf_dir), seen()).select("clip_uid", "frame", "total")
    own = b.groupBy("clip_uid", "frame").agg(F.sum(F.col("kinetic") + F.col("potential")).alias("own"))
    return tidy(t.join(own, ["clip_uid", "frame"]).select("clip_uid", "frame", (F.col("total") - F.col("own")).alias("gap")))
