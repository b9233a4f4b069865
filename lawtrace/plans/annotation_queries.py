"""Whole pairs annotated: cells of order lines, plans of their clips, and motion of the bodies of the same clip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawtrace.operators import annotate, edits, laws, severity, twins
from lawtrace.plans import views
from lawtrace.plans.catalog import query, r, tidy
from lawtrace.plans.motion import CTX, G
from lawtrace.plans.pixel_queries import GATES_SQL, H, PLANS_SQL, W

LAW = ("position_continuity",)


def actor():
    return F.col("body_id") % 15 == 3


def bystander():
    return F.col("body_id") % 15 == 4


def moved_twin(valid: DataFrame) -> DataFrame:
    """The actor stands four radii further from the event on; in even clips a bystander follows two frames later, a unit up."""
    bad = edits.teleport(valid, actor(), F.col("t_event"), 4.0)
    return edits.changed(bad, edits.late(bystander() & (F.col("clip_uid") % 2 == 0), F.col("t_event") + 2), pz=F.col("pz") + 1.0)


def motion(traj: DataFrame, contacts: DataFrame, plans: DataFrame) -> DataFrame:
    """What ``annotate.timeline`` reads of trajectories: the actor's continuity against its twin, and who left the lawful path."""
    valid = traj.join(plans.select("clip_uid", "t_event", annotate.strong_residual().alias("reference")), "clip_uid")
    invalid = moved_twin(valid)
    twin = laws.wide(valid.where(actor()), contacts, views.FPS, CTX, G, LAW).withColumnRenamed(LAW[0], "twin").select(*twins.KEY, "twin")
    own = laws.wide(invalid.where(actor()), contacts, views.FPS, CTX, G, LAW).select(*twins.KEY, LAW[0])
    scored = own.join(twin, twins.KEY).join(plans.select("clip_uid", annotate.strong_residual().alias("reference")), "clip_uid")
    scored = scored.select("clip_uid", "frame", severity.score_against_twin(F.col(LAW[0]), F.col("twin"), F.col("reference")).alias("score"))
    pairs = twins.aligned(valid, invalid)
    who = pairs.where(actor() | bystander()).select("clip_uid", "body_id").distinct()
    left = twins.diverged_frames(pairs, who).withColumn("diverged", F.lit(True))
    absent = invalid.where(actor() & ~F.col("present")).select("clip_uid", "frame", F.lit(True).alias("absent"))
    return scored.join(left, ["clip_uid", "frame"], "full").join(absent, ["clip_uid", "frame"], "full").select("clip_uid", "frame", "score", "diverged", "absent")


def annotated(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Annotations and timelines of the clips that have both cells and trajectories."""
    cells, traj = views.cells(spark, sf_dir), views.traj(spark, sf_dir)
    plans = views.pair_plans(traj.select("clip_uid").distinct())
    plans = plans.join(views.cell_clips(spark, sf_dir), "clip_uid", "left_semi")
    return annotate.annotate_pairs(cells, plans, motion(traj, views.contacts(spark, sf_dir), plans), H, W)


ANNOTATED = f"""{views.sql_with("cells", "traj")}, clip_list as (select distinct clip_uid from traj where clip_uid in (select clip_uid from cells)), {PLANS_SQL},
timed as (select t.*, p.t_event, p.reference, case when t.body_id % 15 = 3 and frame >= t_event then px + 4 * radius else px end as i_px from traj t join pair_plans p on p.clip_uid = t.clip_uid),
steps as (select *, sqrt(vx * vx + vy * vy + vz * vz) as speed, coalesce(sqrt(power(px - lag(px) over b, 2) + power(py - lag(py) over b, 2) + power(pz - lag(pz) over b, 2)), 0) as d, coalesce(sqrt(power(i_px - lag(i_px) over b, 2) + power(py - lag(py) over b, 2) + power(pz - lag(pz) over b, 2)), 0) as i_d
    from timed where body_id % 15 = 3 window b as (partition by clip_uid, body_id order by frame)),
res as (select clip_uid, frame, reference, present, case when frame = 0 then 0 else greatest(d - greatest(lag(speed) over (partition by clip_uid, body_id order by frame), speed) / 12e0 * 1.6e0, 0) / radius end as twin, case when frame = 0 then 0 else greatest(i_d - greatest(lag(speed) over (partition by clip_uid, body_id order by frame), speed) / 12e0 * 1.6e0, 0) / radius end as r from steps),
apart as (select distinct clip_uid, frame from timed where (body_id % 15 = 3 and frame >= t_event) or (body_id % 15 = 4 and clip_uid % 2 = 0 and frame >= t_event + 2)),
moved_rows as (select coalesce(s.clip_uid, a.clip_uid) as clip_uid, coalesce(s.frame, a.frame) as frame, least(greatest(abs(r - twin) / greatest(reference, 1e-9), 0), 1) as score, a.clip_uid is not null as diverged, s.clip_uid is not null and not present as absent
    from res s full join apart a on a.clip_uid = s.clip_uid and a.frame = s.frame),
{GATES_SQL},
every as (select clip_uid, 'valid' as side, 'seg' as annotation, frame, y, x, body_v::double as value from painted where body_v is not null union all select clip_uid, 'invalid', 'seg', frame, y, x, body_i from painted where body_i is not null
    union all select clip_uid, s, 'reference_mask', frame, y, x, 1 from painted, (values ('valid'), ('invalid')) t(s) where in_v union all select clip_uid, 'invalid', 'violation_mask', frame, y, x, 1 from painted where violation
    union all select clip_uid, 'invalid', 'mask_invalid', frame, y, x, 1 from painted where invalid union all select clip_uid, 'invalid', 'severity_map', frame, y, x, severity from painted where severity <> 0
    union all select clip_uid, 'invalid', 'divergence_map', frame, y, x, divergence from painted where divergence <> 0 union all select clip_uid, 'invalid', 'causal_mask', frame, y, x, level from levels)"""


@query(ANNOTATED + f" select clip_uid, side, annotation, count(*) as pixels, {r('sum(value * (1 + (frame * 256 + y * 16 + x) % 97))', 'checksum', 4)} from every group by 1, 2, 3")
def annotate_pairs(spark, sf_dir):
    """Every annotation of both sides of each pair: pixels and a checksum."""
    rows, _ = annotated(spark, sf_dir)
    check = F.sum(F.col("value") * (1 + (F.col("frame") * 256 + F.col("y") * 16 + F.col("x")) % 97))
    return tidy(rows.groupBy("clip_uid", "side", "annotation").agg(F.count("*").alias("pixels"), check.alias("checksum")), 4)


@query(ANNOTATED + f" select clip_uid, frame, {r('score', 'score')}, diverged, absent, observable, visible, {r('s_visible', 's_visible')}, visible_inv, {r('s_inv', 's_inv')}, causal, gone from gates")
def annotated_timelines(spark, sf_dir):
    """The timelines of the same pairs, with scores of their trajectories."""
    _, times = annotated(spark, sf_dir)
    return tidy(times.select("clip_uid", "frame", "score", "diverged", "absent", "observable", "visible", "s_visible", "visible_inv", "s_inv", "causal", "gone"))
