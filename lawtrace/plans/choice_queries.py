"""Queries on what plans act on, when, and how results are laid out."""

from __future__ import annotations

from pyspark.sql import functions as F

from lawtrace.operators import choices, edits, twins
from lawtrace.plans import views
from lawtrace.plans.catalog import crc32_sql, query, r, tidy
from lawtrace.plans.frames import LATE
from lawtrace.plans.geometry_queries import ENDS
from lawtrace.plans.motion import BODY, TWIN_SQL, culprit, sized
from lawtrace.plans.release_queries import STAGED, staged

TCB = views.sql_with("traj", "contacts", "bodies")


@query(f"""{TCB}, c as (select distinct clip_uid, [clip_uid * 15 + 9, clip_uid * 15 + 3 + clip_uid % 3 * 6, clip_uid * 15 + 4] as causal from bodies), k as (select clip_uid, causal, list_filter(causal, lambda i: i % 15 not in (0, 9, 10)) as dynamic_ids, list_filter(causal, lambda i: i % 15 in (0, 9, 10)) as static_ids from c)
select clip_uid, array_to_string(dynamic_ids, ',') as dynamic_ids, array_to_string(static_ids, ',') as static_ids, coalesce(dynamic_ids[1], causal[1]) as "primary" from k""")
def plan_participants(spark, sf_dir):
    b = views.bodies(spark, sf_dir)
    first = F.col("clip_uid") * 15
    plans = b.select("clip_uid").distinct().withColumn("causal", F.array(first + 9, first + 3 + F.col("clip_uid") % 3 * 6, first + 4))
    p = choices.participants(plans, b)
    return p.select("clip_uid", *[F.array_join(c, ",").alias(c) for c in ("dynamic_ids", "static_ids")], "primary")


MEMBERS = f"""{TCB}, live as (select *, count(*) over (partition by clip_uid) as n, {crc32_sql("clip_uid::varchar || '|' || body_id::varchar || '|members'")} as u from bodies where not static and not dormant and ord < 9 and clip_uid % 4 <> 1),
k as (select *, case when clip_uid % 4 = 2 then 1 else least(greatest(round_even(0.6e0 * n, 0)::int, 2), n) end as k, row_number() over (partition by clip_uid order by case when clip_uid % 4 <> 2 then u end, ord) as place from live)
select clip_uid, body_id, ord, case when clip_uid % 4 = 2 then 'first' else 'share' end as chosen_by from k where place <= k union all select clip_uid, body_id, 14 - ord, 'declared' from bodies where clip_uid % 4 = 1 and ord in (5, 6)"""


@query(MEMBERS)
def target_members(spark, sf_dir):
    """The members of every clip: declared in one clip of four, the first actor in one, a drawn share in the others."""
    b = views.bodies(spark, sf_dir).withColumns({"actor": ~F.col("static") & (F.col("ord") < 9), "fraction": F.when(F.col("clip_uid") % 4 != 2, 0.6)})
    declared = b.where("clip_uid % 4 = 1 and ord in (5, 6)").select("clip_uid", "body_id", (14 - F.col("ord")).alias("ord"))
    return choices.members(b, declared)


@query("select o_orderkey, o_orderkey % 10 % 5 = 4 and o_orderkey % 3 <> 0 and o_orderpriority <> '1-URGENT' as moves from orders")
def moving_variants(spark, sf_dir):
    """Orders as variants: the last of each block of five moves, where level and scene allow it."""
    o = views.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", choices.camera_moves(F.col("o_orderkey") % 10, F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority") != "1-URGENT").alias("moves"))


ACTING = f"""{TCB}, {ENDS}, z as (select clip_uid, max(frame) + 1 as frames from traj group by 1), near as (select distinct clip_uid, body_id, frame + d as frame from (select * from ends where seq % 3 = 0), (values (-1), (0), (1)) t(d)),
free as (select t.clip_uid, t.body_id, t.frame, t.frame - row_number() over (partition by t.clip_uid, t.body_id order by t.frame) as g from traj t where not exists (select 1 from near n where n.clip_uid = t.clip_uid and n.body_id = t.body_id and n.frame = t.frame)),
runs as (select clip_uid, body_id, min(frame) as s, max(frame) as e, row_number() over (partition by clip_uid, body_id order by count(*) desc, min(frame)) as k from free group by clip_uid, body_id, g having count(*) >= 2),
w as (select b.clip_uid, b.body_id, frames, cast(5 + b.ord * 3 as int) as want, (b.ord * 7 % 15) / 15e0 as unit, s, e, e - round_even(0.4e0 * (e - s), 0)::int as latest, greatest(s + 1, 1, round_even(frames * (1 / 6e0), 0)::int) as earliest from bodies b join z on z.clip_uid = b.clip_uid left join runs r on r.clip_uid = b.clip_uid and r.body_id = b.body_id and k = 1),
p as (select *, case when want between earliest and latest then want when greatest(earliest, latest) <= earliest then earliest else earliest + round_even(unit * (greatest(earliest, latest) - earliest), 0)::int end as placed from w)
select clip_uid, body_id, want, cast(case when s is not null and placed >= 1 and placed < frames - 1 then placed else want end as int) as frame from p"""


@query(ACTING)
def frame_acting(spark, sf_dir):
    """When to act on every body, inside its longest run without contacts."""
    b, t = views.bodies(spark, sf_dir), views.traj(spark, sf_dir)
    frames = t.groupBy("clip_uid").agg((F.max("frame") + 1).alias("frames"))
    touching = views.contacts(spark, sf_dir).where("seq % 3 = 0").select("clip_uid", "frame", F.explode(F.array("body_a", "body_b")).alias("body_id"))
    wanted = b.join(frames, "clip_uid").select("clip_uid", "body_id", "frames", (5 + F.col("ord") * 3).cast("int").alias("want"), (F.col("ord") * 7 % 15 / 15.0).alias("unit"))
    return choices.acting_frames(wanted, choices.contact_free_runs(t.select("clip_uid", "body_id", "frame"), touching)).select("clip_uid", "body_id", "want", "frame")


@query(STAGED + """, c as (select pair_uid, family, clip_uid, case when label = 'valid' then 'valid' else severity_bin end as severity from staged), k as (select distinct pair_uid, family, severity, case severity when 'valid' then 0 when 'weak' then 1 when 'medium' then 2 else 3 end as rank from c)
select c.pair_uid, c.family, any_value(shown) as shown, """ + ", ".join(f"max(clip_uid) filter (where severity = '{n}') as {n}" for n in choices.SEVERITIES) + " from c join (select pair_uid, family, string_agg(severity, ',' order by rank) as shown from k group by 1, 2) s on s.pair_uid = c.pair_uid and s.family = c.family group by 1, 2")
def severity_columns(spark, sf_dir):
    """Each pair and family with its clips in the order of severity."""
    c = staged(spark, sf_dir).withColumn("severity", F.when(F.col("label") == "valid", "valid").otherwise(F.col("severity_bin")))
    return choices.comparison(c).withColumn("shown", F.array_join("shown", ","))


@query(STAGED + " select clip_uid, scenario, family, severity_bin from staged where scenario in ('drop', 'toss', 'pour') and family in ('permanence', 'antigravity', 'fusion') and severity_bin in ('weak', 'strong') order by clip_uid limit 40")
def clip_selection(spark, sf_dir):
    """The first forty clips of some cells."""
    c = staged(spark, sf_dir).select("clip_uid", "scenario", "family", "severity_bin")
    return choices.selected(c, ["drop", "toss", "pour"], ["permanence", "antigravity", "fusion"], ["weak", "strong"], 40)


@query(f"{TCB} select c.clip_uid, c.seq from contacts c where not ((c.body_a % 15 = 3 and c.body_b % 15 = 4 or c.body_a % 15 = 4 and c.body_b % 15 = 3) and c.frame between 5 + c.clip_uid % 4 and 30)")
def contacts_suppressed(spark, sf_dir):
    """Contacts without those of a suppressed pair inside its window."""
    c = views.contacts(spark, sf_dir)
    first = F.col("clip_uid") * 15
    pairs = c.select("clip_uid").distinct().select("clip_uid", (first + 4).alias("one"), (first + 3).alias("other"), (5 + F.col("clip_uid") % 4).alias("s"), F.lit(30).alias("e"))
    return edits.without_pair(c, pairs).select("clip_uid", "seq")


@query(f"{TCB}, both_sides as (select clip_uid, frame, seq, impulse, 'lawful' as side from contacts union all select clip_uid, frame, seq, impulse * 2, 'tail' from contacts where seq % 3 = 0) select clip_uid, frame, seq, {r('impulse', 'impulse')} from both_sides where case when clip_uid % 5 = 4 then side = 'lawful' when side = 'lawful' then frame < 10 + clip_uid % 7 else frame >= 10 + clip_uid % 7 end")
def twin_contacts(spark, sf_dir):
    """Lawful contacts before the event of a clip, and those of its replacement from it on; one clip of five has no event."""
    c = views.contacts(spark, sf_dir).select("clip_uid", "frame", "seq", "impulse")
    events = c.select("clip_uid").distinct().where("clip_uid % 5 <> 4").withColumn("t0", 10 + F.col("clip_uid") % 7)
    return tidy(twins.spliced_contacts(c, c.where("seq % 3 = 0").withColumn("impulse", F.col("impulse") * 2), events))


_u = "((frame - t_event) / 12e0)"
_y = f"(case when {LATE} and frame <= t_event + 12 then py + sin(2 * pi() * 1.75e0 * {_u}) * power(sin(pi() * {_u}), 2) * 1.5e0 * radius else py end)"


@query(f"{TWIN_SQL}, w as (select *, {_y} as wy_ from timed) select clip_uid, body_id, frame, {r(f'case when body_id % 15 = 3 then coalesce((wy_ - lag(wy_) {BODY}) * 12, (lead(wy_) {BODY} - wy_) * 12, 0) else vy end', 'vy')} from w")
def edit_wiggle_velocity(spark, sf_dir):
    """A wiggle whose velocities are those of its own path."""
    t = edits.wiggle(sized(spark, sf_dir), culprit(), F.col("t_event"), F.col("t_event") + 12, 1.5, top=1.0, fps=views.FPS)
    return tidy(t.select("clip_uid", "body_id", "frame", "vy"))
