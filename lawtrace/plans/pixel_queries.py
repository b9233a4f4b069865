"""Queries on pixels: two sides of 25 frames of 16 x 16, where body 1 is the culprit, 2 moves and 3 is static."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawtrace.operators import annotate, intervals, pixels, taxonomy, validation
from lawtrace.operators.severity import score_against_twin
from lawtrace.plans import views
from lawtrace.plans.catalog import query, r, tidy

T, H, W = 25, 16, 16
RESIDUAL = "((clip_uid * 3 + frame * 5) % 11) / 10e0"
LEFT, ABSENT = "frame >= 5 + clip_uid % 7 and clip_uid % 2 = 0 and frame % 2 = 0", "frame % 5 = 1 and clip_uid % 3 = 0"
SCORE = "((clip_uid * 3 + frame * 5 + body_id * 7) % 11) / 10e0"
PX = "clip_uid, frame, y, x"


def attributed_sql(name: str, source: str, active: str, observable: str) -> str:
    """CTEs that place the scores of ``source`` (clip_uid, frame, score) by joins: ``name`` (clip_uid, frame, placed) of the gated frames."""
    n = name
    return f"""{n}_runs as (select clip_uid, min(frame) as s, max(frame) as e from (select *, frame - row_number() over (partition by clip_uid order by frame) as g from {source} where {active}) group by clip_uid, g),
{n}_next as (select *, lead(s) over (partition by clip_uid order by s) as nxt from {n}_runs),
{n}_inside as (select x.clip_uid, x.frame, max(y.score) as placed from {source} x join {n}_runs w on x.clip_uid = w.clip_uid and x.frame between w.s and w.e join {source} y on y.clip_uid = x.clip_uid and y.frame between w.s and x.frame
    and y.frame > coalesce((select max(z.frame) from {source} z where z.clip_uid = x.clip_uid and z.{observable} and z.frame between w.s and x.frame - 1), -1) where x.{observable} group by 1, 2),
{n}_spilled as (select w.clip_uid, min(x.frame) as frame, (select max(y.score) from {source} y where y.clip_uid = w.clip_uid and y.frame between w.s and w.e) as placed
    from {n}_next w join {source} x on x.clip_uid = w.clip_uid and x.{observable} and x.frame > w.e and x.frame < coalesce(w.nxt, 1000000000)
    where not exists (select 1 from {source} q where q.clip_uid = w.clip_uid and q.{observable} and q.frame between w.s and w.e) group by w.clip_uid, w.s, w.e),
{n} as (select * from {n}_inside union all select * from {n}_spilled)"""


#: Plans of the clips in ``clip_list`` and their frames.
PLANS_SQL = f"""fams(family_no, family, detectable, strong) as (values {", ".join(f"({i}, '{f[0]}', '{f[4]}', {f[6]!r}::double)" for i, f in enumerate(taxonomy.FAMILIES))}),
pair_plans as (select p.*, f.family, f.detectable, coalesce(nullif(p.r_strong, 0), f.strong) as reference from ({views.PAIR_PLANS.format(clips="clip_list")}) p join fams f on p.family_no = f.family_no),
frame_list as (select clip_uid, cast(f as int) as frame from clip_list, range({T}) as t(f))"""
#: What their cells show: flags, gates and pixels, for motion in ``moved_rows`` (clip_uid, frame, score, diverged, absent).
GATES_SQL = f"""both_sides as (select *, coalesce(body_v = 1, false) as in_v, coalesce(body_i = 1, false) as in_i, greatest(abs(coalesce(r_v, 0) - coalesce(r_i, 0)), abs(coalesce(g_v, 0) - coalesce(g_i, 0)), abs(coalesce(b_v, 0) - coalesce(b_i, 0))) as diff,
    (coalesce(r_v, 0) <> coalesce(r_i, 0))::int + (coalesce(g_v, 0) <> coalesce(g_i, 0))::int + (coalesce(b_v, 0) <> coalesce(b_i, 0))::int as channels from cells),
obs as (select clip_uid, frame from both_sides where in_v or in_i group by 1, 2 having bool_or(in_v <> in_i) or count(*) filter (where body_v is not null and body_i is not null and diff >= 8) >= 4),
line as (select f.clip_uid, f.frame, coalesce(f.frame between v1 and v2 or f.frame between v3 and v4, false) as active, coalesce(case when i1 is null then f.frame between v1 and v2 or f.frame between v3 and v4 else f.frame between i1 and i2 end, false) as intervening,
    coalesce(case when c1 is null then f.frame between v1 and v2 or f.frame between v3 and v4 else f.frame between c1 and c2 end, false) as consequence, detectable, coalesce(m.score, 0) as score, coalesce(m.diverged, false) as diverged, coalesce(m.absent, false) as absent,
    exists (select 1 from obs o where o.clip_uid = f.clip_uid and o.frame = f.frame) as observable, exists (select 1 from both_sides b where b.clip_uid = f.clip_uid and b.frame = f.frame and in_i) as seen_invalid,
    not exists (select 1 from both_sides b where b.clip_uid = f.clip_uid and b.frame = f.frame and body_v = 1) as occluded_v, not exists (select 1 from both_sides b where b.clip_uid = f.clip_uid and b.frame = f.frame and body_i = 1) as occluded_i
    from frame_list f join pair_plans p on p.clip_uid = f.clip_uid left join moved_rows m on m.clip_uid = f.clip_uid and m.frame = f.frame),
scored_line as (select *, case when detectable = 'event' then intervening else consequence end as scored, observable and seen_invalid as both_seen from line),
{attributed_sql("twins_show", "scored_line", "scored", "observable")},
{attributed_sql("invalid_shows", "scored_line", "scored", "both_seen")},
gates as (select l.*, a.placed is not null as visible, coalesce(a.placed, 0) as s_visible, b.placed is not null as visible_inv, coalesce(b.placed, 0) as s_inv, a.placed is not null or b.placed is not null as seen, (consequence or diverged) and observable as causal,
    a.placed is not null and absent and not (b.placed is not null and seen_invalid) as gone
    from scored_line l left join twins_show a on a.clip_uid = l.clip_uid and a.frame = l.frame left join invalid_shows b on b.clip_uid = l.clip_uid and b.frame = l.frame),
painted as (select b.clip_uid, b.frame, b.y, b.x, body_v, body_i, in_v, in_i, seen and (in_v or in_i) as violation, visible_inv and in_i as invalid, case when in_i and visible_inv then s_inv when in_v and gone then s_visible else 0 end as severity, diff / 255e0 as divergence, causal
    from both_sides b join gates g on g.clip_uid = b.clip_uid and g.frame = b.frame),
near as (select distinct clip_uid, frame, (y + dy + {H}) % {H} as y, (x + dx + {W}) % {W} as x from painted, (select unnest(range(-3, 4)) as dy) a, (select unnest(range(-3, 4)) as dx) b where causal and in_i),
levels as (select clip_uid, frame, y, x, case when in_i then 1 else 2 end as level from painted p where causal and (in_i or (body_i = 2 and clip_uid % 2 = 0) or (body_i = 3 and exists (select 1 from near n where n.clip_uid = p.clip_uid and n.frame = p.frame and n.y = p.y and n.x = p.x))))"""

BASE = f"""{views.sql_with("cells")}, v as (select {PX}, body_v as body_id, r_v as r, g_v as g, b_v as b from cells where body_v is not null), i as (select {PX}, body_i as body_id, r_i as r, g_i as g, b_i as b from cells where body_i is not null),
seg as (select *, 'F' as side from v union all select *, 'O' as side from i), clip_list as (select distinct clip_uid from cells),
{PLANS_SQL},
moved_rows as (select clip_uid, frame, least(greatest(({RESIDUAL}) / greatest(reference, 1e-9), 0), 1) as score, {LEFT} as diverged, {ABSENT} as absent from (select clip_uid, cast(f as int) as frame, reference from pair_plans, range({T}) as t(f))),
{GATES_SQL},
mask as (select {PX} from painted where violation),
field as (select {PX}, severity as score from painted where severity <> 0 and in_i and invalid),
diverged as (select {PX}, diff / 255e0 as divergence from both_sides where diff > 0)
"""


class Scene:
    """The derived tables of one run, all dealt by clip as the cells are."""

    def __init__(self, spark, sf_dir):
        self.cells = views.cells(spark, sf_dir)
        self.clips = self.cells.select("clip_uid").distinct()
        self.plans = views.pair_plans(self.clips)
        self.frames = self.clips.withColumn("frame", F.explode(F.sequence(F.lit(0), F.lit(T - 1))))

    def side(self, s):
        return self.cells.where(f"body_{s} is not null").select(*pixels.PIXEL, F.col(f"body_{s}").alias("body_id"), *[F.col(f"{c}_{s}").alias(c) for c in "rgb"])

    @property
    def v(self):
        return self.side("v")

    @property
    def i(self):
        return self.side("i")

    @property
    def seg(self):
        return self.v.unionByName(self.i)

    @property
    def culprits(self):
        return self.clips.withColumn("body_id", F.lit(1))

    def both(self):
        return annotate.compared(self.cells, self.plans)

    def motion(self):
        frames = self.plans.select("clip_uid", annotate.strong_residual().alias("reference"), F.explode(F.sequence(F.lit(0), F.col("frames") - 1)).alias("frame"))
        score = score_against_twin(F.expr(RESIDUAL), F.lit(0.0), F.col("reference"))
        return frames.select("clip_uid", "frame", score.alias("score"), F.expr(LEFT).alias("diverged"), F.expr(ABSENT).alias("absent"))

    def times(self):
        return annotate.timeline(self.both(), self.plans, self.motion())

    def painted(self):
        return annotate.painted(self.both(), self.times())

    def mask(self):
        return self.painted().where("violation").select(*pixels.PIXEL)

    def field(self):
        return self.painted().where("invalid and severity <> 0").select(*pixels.PIXEL, F.col("severity").alias("score"))


@query(BASE + f"select {PX} from v where body_id = 1")
def mask_footprint(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return pixels.footprint(s.v, s.culprits).select(*pixels.PIXEL)


@query(BASE + "select * from obs")
def observable_frames(spark, sf_dir):
    return pixels.observable_frames(Scene(spark, sf_dir).both())


@query(BASE + f"select {PX}, {r('divergence', 'divergence')} from diverged")
def divergence_map(spark, sf_dir):
    return tidy(pixels.divergence(Scene(spark, sf_dir).both()))


@query(BASE + "select c.clip_uid, coalesce(sum(channels), 0)::bigint as differences from clip_list c left join both_sides b on c.clip_uid = b.clip_uid and b.frame < 5 + c.clip_uid % 7 group by 1")
def pixel_prefix(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return pixels.prefix_differences(s.both(), s.clips.withColumn("t_event", 5 + F.col("clip_uid") % 7))


@query(BASE + "select * from frame_list f where not exists (select 1 from i where i.clip_uid = f.clip_uid and i.frame = f.frame and i.body_id = 1)")
def occluded_frames(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return pixels.occluded_frames(s.frames, s.i, F.lit(1))


@query(BASE + "select * from mask")
def violation_mask(spark, sf_dir):
    return Scene(spark, sf_dir).mask()


@query(BASE + "select clip_uid, frame, active, intervening, consequence, scored, observable, seen_invalid, occluded_i, visible, " + r("s_visible", "s_visible") + ", visible_inv, " + r("s_inv", "s_inv") + ", seen, causal, gone from gates")
def gate_timeline(spark, sf_dir):
    """Every named gate of every frame, from plans dispatched by family, what the cells show and the motion."""
    return tidy(Scene(spark, sf_dir).times().drop("diverged", "absent", "occluded_v", "score"))


@query(BASE + f"select {PX} from painted where invalid")
def invalid_mask(spark, sf_dir):
    return Scene(spark, sf_dir).painted().where("invalid").select(*pixels.PIXEL)


@query(BASE + f"select {PX} from painted where in_v")
def reference_mask(spark, sf_dir):
    """Where culprits should be: their lawful footprint, on all frames."""
    return Scene(spark, sf_dir).painted().where("reference").select(*pixels.PIXEL)


@query(BASE + f"select clip_uid, count(*) as outside from (select {PX} from i where body_id in (1, 2) except select {PX} from mask) group by 1")
def mask_subset(spark, sf_dir):
    """Pixels of a wider footprint that the mask does not hold."""
    s = Scene(spark, sf_dir)
    return pixels.outside(s.i.where("body_id in (1, 2)").select(*pixels.PIXEL), s.mask()).groupBy("clip_uid").agg(F.count("*").alias("outside"))


DILATED = f"dil as (select distinct clip_uid, frame, (y + dy + {H}) % {H} as y, (x + dx + {W}) % {W} as x from i, (select unnest(range(-3, 4)) as dy) a, (select unnest(range(-3, 4)) as dx) b where body_id = 1)"


@query(f"{BASE}, {DILATED} select clip_uid, frame, count(*) as n, sum(y * {W} + x)::bigint as s from dil group by 1, 2")
def mask_dilated(spark, sf_dir):
    s = Scene(spark, sf_dir)
    d = pixels.dilated(pixels.footprint(s.i, s.culprits), 3, H, W)
    return d.groupBy("clip_uid", "frame").agg(F.count("*").alias("n"), F.sum(F.col("y") * W + F.col("x")).cast("long").alias("s"))


@query(BASE + "select * from levels")
def causal_mask(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return annotate.causal_levels(s.painted(), s.plans, H, W)


@query(BASE + f"select {PX}, {r('score', 'score')} from field")
def severity_map(spark, sf_dir):
    return tidy(Scene(spark, sf_dir).field())


@query(BASE + f"select clip_uid, cast(f as int) as frame, cast(y as int) as y, cast(x as int) as x, {r('(clip_uid + f) % 7 / 6e0', 'score')} from (select distinct clip_uid from seg), range({T}) a(f), range({H}) b(y), range({W}) c(x)")
def severity_everywhere(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return tidy(pixels.painted_everywhere(s.frames.withColumn("score", (F.col("clip_uid") + F.col("frame")) % 7 / 6.0), H, W))


@query(BASE + f"select {PX}, {r('severity', 'score')} from painted where severity <> 0")
def severity_vanished(spark, sf_dir):
    """The severity map with the lawful footprint of culprits that are gone and leave no pixel."""
    return tidy(Scene(spark, sf_dir).painted().where("severity <> 0").select(*pixels.PIXEL, F.col("severity").alias("score")))


@query(BASE + "select c.clip_uid, b.body_id, min(frame) as first_frame, max(frame) as last_frame, count(frame) as frames_visible, coalesce(max(n), 0) as peak_pixels from clip_list c cross join (select unnest(range(1, 6)) as body_id) b left join (select clip_uid, body_id, frame, count(*) n from i group by 1, 2, 3) p on p.clip_uid = c.clip_uid and p.body_id = b.body_id group by 1, 2")
def instance_visibility(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return pixels.visibility(s.clips.withColumn("body_id", F.explode(F.sequence(F.lit(1), F.lit(5)))), s.i)


@query(BASE + ", p as (select clip_uid, frame, count(*) n from mask group by 1, 2) select c.clip_uid, count(p.frame) as frames_nonempty, coalesce(max(n), 0) as peak_pixels, coalesce(arg_max(p.frame, n * 1000 - p.frame), 0) as peak_frame from clip_list c left join p on c.clip_uid = p.clip_uid group by 1")
def mask_summary(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return pixels.mask_summary(s.clips.withColumn("frames", F.lit(T)), s.mask())


@query(BASE + f"select f.clip_uid, f.frame, {r('coalesce(max(score), 0)', 'score')} from frame_list f left join field x on f.clip_uid = x.clip_uid and f.frame = x.frame group by 1, 2")
def severity_profile(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return tidy(pixels.profile(s.frames, s.field()))


AUDIT_SQL = BASE + f""", shown as (select c.clip_uid, coalesce((select max(score) from field f where f.clip_uid = c.clip_uid), 0) as peak_severity, (select count(distinct frame) from obs o where o.clip_uid = c.clip_uid) as observable_frames,
    coalesce((select max(divergence) from mask m join diverged d using (clip_uid, frame, y, x) where m.clip_uid = c.clip_uid), 0) as evidence from clip_list c)
select clip_uid, {r('peak_severity', 'peak_severity')}, observable_frames, {r('evidence', 'evidence')}, peak_severity < 0.02 and observable_frames < 1 and evidence < 0.02 as invisible, evidence >= 0.02 and peak_severity < 0.02 as unscored from shown"""


@query(AUDIT_SQL)
def audit_measure(spark, sf_dir):
    m = annotate.measured(Scene(spark, sf_dir).painted())
    return tidy(m.withColumn("invisible", F.expr(pixels.INVISIBLE)).withColumn("unscored", F.expr(pixels.UNSCORED)))


@query(f"with a as ({AUDIT_SQL}) select clip_uid, peak_severity from a where not invisible order by peak_severity, clip_uid limit 10")
def audit_weakest(spark, sf_dir):
    """The ten weakest visible clips."""
    return audit_measure(spark, sf_dir).where("not invisible").orderBy("peak_severity", "clip_uid").limit(10).select("clip_uid", "peak_severity")


GRID = f""", grid as (select clip_uid, cast(ceil(frame / 4e0) as int) f_lat, cast(floor(y / 2e0) as int) h_lat, cast(floor(x / 2e0) as int) w_lat, bool_or(violation) as hit, max(severity) as peak, sum(severity) / (case when ceil(frame / 4e0) = 0 then 4e0 else 16e0 end) as mean from painted where violation or severity <> 0 group by 1, 2, 3, 4, ceil(frame / 4e0))"""


@query(BASE + GRID + f" select clip_uid, f_lat, h_lat, w_lat, hit, {r('peak', 'peak')}, {r('mean', 'mean')} from grid")
def token_grid(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return tidy(annotate.token_grid(s.painted(), T, H, W, 8))


@query(BASE + GRID + f" select c.clip_uid, f.f::int as f_lat, h.h::int as h_lat, w.w::int as w_lat, coalesce(hit, false) as hit, {r('coalesce(peak, 0)', 'peak')}, {r('coalesce(mean, 0)', 'mean')} from clip_list c cross join range(7) f(f) cross join range(8) h(h) cross join range(8) w(w) left join grid g on g.clip_uid = c.clip_uid and g.f_lat = f.f and g.h_lat = h.h and g.w_lat = w.w")
def token_grid_dense(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return tidy(pixels.dense_grid(s.clips, annotate.token_grid(s.painted(), T, H, W, 8), T, 8))


@query(BASE + """, first_seen as (select clip_uid, min(frame) as first from obs group by 1)
select p.clip_uid, v1 as t_event, coalesce(v4, v2) as t_end, coalesce(first, v1) as t_obs, coalesce(first, v1) - v1 as lag, g.occluded_i as occluded_at_event, coalesce(i2, v4, v2) as t_intervention_end, coalesce(c2, v4, v2) as t_consequence_end
from pair_plans p left join first_seen o on o.clip_uid = p.clip_uid join gates g on g.clip_uid = p.clip_uid and g.frame = v1""")
def temporal_block(spark, sf_dir):
    """Event, end, first observable frame, lag, and whether the culprit is hidden at the event."""
    s = Scene(spark, sf_dir)
    return annotate.temporal_block(s.times(), s.plans)


@query(BASE + f", e as (select clip_uid, frame, body_id, ((frame + body_id * 3 + clip_uid) % 13 - 4) * 1e0 as energy from (select distinct clip_uid, frame, body_id from seg)), z as (select clip_uid, greatest(abs(sum(energy)), 1e-9) as e0 from e where frame = 0 group by 1) select i.clip_uid, i.frame, i.y, i.x, {r('energy / e0', 'share')} from i join e on i.clip_uid = e.clip_uid and i.frame = e.frame and i.body_id = e.body_id join z on z.clip_uid = i.clip_uid where energy <> 0")
def energy_map(spark, sf_dir):
    s = Scene(spark, sf_dir)
    e = s.seg.select("clip_uid", "frame", "body_id").distinct().withColumn("energy", ((F.col("frame") + F.col("body_id") * 3 + F.col("clip_uid")) % 13 - 4) * 1.0)
    z = e.where("frame = 0").groupBy("clip_uid").agg(F.greatest(F.abs(F.sum("energy")), F.lit(1e-9)).alias("e0"))
    return tidy(pixels.painted(s.i, e.join(z, "clip_uid").withColumn("share", F.col("energy") / F.col("e0")), "share"))


@query(BASE + f", m as (select clip_uid, frame, sqrt(r * r + g * g) as mag from i) select clip_uid, frame, {r('greatest(coalesce(quantile_cont(mag, 0.99) filter (where mag > 100), quantile_cont(mag, 0.99)), 1e-6)', 'scale')} from m group by 1, 2")
def flow_scale(spark, sf_dir):
    """99th percentile of moving magnitudes of a frame, else of all."""
    m = Scene(spark, sf_dir).i.withColumn("mag", F.sqrt(F.col("r") * F.col("r") + F.col("g") * F.col("g")))
    top = F.coalesce(F.percentile(F.when(F.col("mag") > 100, F.col("mag")), F.lit(0.99)), F.percentile("mag", F.lit(0.99)))
    return tidy(m.groupBy("clip_uid", "frame").agg(F.greatest(top, F.lit(1e-6)).alias("scale")))


CHECKED = BASE + """, lines as (select clip_uid, frame, frame between 5 and 15 as expected, (frame between 5 and 15) <> (frame % 11 = 7 and clip_uid % 3 = 0) as active, frame % 2 = 0 as observable from frame_list)"""


def _timelines(s):
    """Timelines with some wrong flags."""
    t = s.frames.withColumn("expected", F.col("frame").between(5, 15))
    return t.withColumn("active", F.col("expected") != ((F.col("frame") % 11 == 7) & (F.col("clip_uid") % 3 == 0))).withColumn("observable", F.col("frame") % 2 == 0)


@query(CHECKED + " select clip_uid, frame, 'timeline differs' as rule from lines where expected <> active")
def validation_timelines(spark, sf_dir):
    s = Scene(spark, sf_dir)
    windows = s.clips.select("clip_uid", F.lit(5).alias("s"), F.lit(15).alias("e"))
    return validation.timeline_violations(windows, _timelines(s).select("clip_uid", "frame", "active"))


@query(CHECKED + ", n as (select clip_uid, frame, count(*) as n from mask group by 1, 2) select l.clip_uid, l.frame, case when observable then 'mask empty' else 'mask where nothing shows' end as rule from lines l left join n on n.clip_uid = l.clip_uid and n.frame = l.frame where active and observable <> (coalesce(n, 0) > 0)")
def validation_masks(spark, sf_dir):
    s = Scene(spark, sf_dir)
    return validation.mask_violations(_timelines(s).select("clip_uid", "frame", "active", "observable"), s.mask())


@query(BASE + "select f.clip_uid, f.frame, 'severity differs' as rule from frame_list f left join field x on x.clip_uid = f.clip_uid and x.frame = f.frame group by 1, 2 having abs(coalesce(max(score), 0) - case when f.frame % 5 = 0 then coalesce(max(score), 0) else 0.5e0 end) > 1e-3")
def validation_profiles(spark, sf_dir):
    s = Scene(spark, sf_dir)
    profile = pixels.profile(s.frames, s.field())
    recorded = profile.withColumn("severity", F.when(F.col("frame") % 5 == 0, F.col("score")).otherwise(0.5)).drop("score")
    return validation.profile_violations(profile, recorded)


@query(BASE + f", shifted as (select {PX} from i join gates g using (clip_uid, frame) where body_id = 1 and (visible_inv or frame % 7 = 2)), out as (select distinct clip_uid from (select * from shifted except select * from mask)) select clip_uid, case when clip_uid % 4 = 1 then 'masks differ in size' else 'mask outside the union' end as rule from (select clip_uid from out union select clip_uid from clip_list where clip_uid % 4 = 1)")
def validation_parts(spark, sf_dir):
    """Invalid-side masks with pixels of frames that nothing gates, and clips whose masks differ in size."""
    s = Scene(spark, sf_dir)
    part = s.painted().join(s.times().select("clip_uid", "frame", F.col("visible_inv").alias("own")), pixels.FRAME).where("in_i and (own or frame % 7 = 2)").select(*pixels.PIXEL)
    shape = lambda h: F.struct(F.lit(T).alias("frames"), h.alias("height"), F.lit(W).alias("width"))
    sizes = s.clips.select("clip_uid", shape(F.lit(H)).alias("mask_size"), shape(F.when(F.col("clip_uid") % 4 == 1, H // 2).otherwise(H)).alias("part_size"))
    return validation.part_violations(part, s.mask(), sizes)


@query(BASE + """, lines as (select g.clip_uid, g.frame, g.active <> (g.frame = 9 and g.clip_uid % 3 = 1) as active, g.observable <> (g.frame = 11 and g.clip_uid % 2 = 0) as observable, g.active as right_active, g.observable as right_observable,
    coalesce((select max(severity) from painted p where p.clip_uid = g.clip_uid and p.frame = g.frame), 0) as largest, g.frame % 10 = 3 as wrong from gates g where g.clip_uid % 5 <> 4),
n as (select clip_uid, frame, count(*) as n from mask group by 1, 2)
select clip_uid, null::int as frame, 'annotation missing' as rule from clip_list where clip_uid % 5 = 4 union all select clip_uid, frame, 'active differs' from lines where active <> right_active union all select clip_uid, frame, 'observable differs' from lines where observable <> right_observable
union all select l.clip_uid, l.frame, case when l.observable then 'mask empty' else 'mask where nothing shows' end from lines l left join n on n.clip_uid = l.clip_uid and n.frame = l.frame where l.active and l.observable <> (coalesce(n, 0) > 0)
union all select clip_uid, frame, 'severity differs' from lines where wrong""")
def validation_annotations(spark, sf_dir):
    """Annotations with planted faults: a table missing in every fifth clip, flags off in some frames, a severity off in every tenth."""
    s = Scene(spark, sf_dir)
    times, painted = s.times(), s.painted()
    severities = pixels.profile(s.frames, painted.select("clip_uid", "frame", F.col("severity").alias("score")))
    lines = times.select("clip_uid", "frame", (F.col("active") != ((F.col("frame") == 9) & (F.col("clip_uid") % 3 == 1))).alias("active"), (F.col("observable") != ((F.col("frame") == 11) & (F.col("clip_uid") % 2 == 0))).alias("observable"))
    lines = lines.join(severities, pixels.FRAME).withColumn("severity", F.col("score") + F.when(F.col("frame") % 10 == 3, 0.5).otherwise(0.0)).drop("score")
    spans = lambda flag, name: intervals.as_windows(times, ["clip_uid"], flag).withColumnRenamed("windows", name)
    empty = F.array().cast("array<struct<s:int,e:int>>")
    records = s.clips.join(spans("active", "violation_windows"), "clip_uid", "left").join(spans("observable", "observable_windows"), "clip_uid", "left")
    records = records.withColumns({c: F.coalesce(c, empty) for c in ("violation_windows", "observable_windows")})
    held = s.clips.select("clip_uid", F.explode(F.array_compact(F.array(F.lit("timelines"), F.lit("violation_mask"), F.when(F.col("clip_uid") % 5 != 4, "severity_map")))).alias("name"))
    return validation.annotation_violations(records, lines, s.mask(), severities, held)
