"""Trajectory, pixel and clip tables derived from the driver's tables.

Each text is SQL that Spark and DuckDB read alike; ``{events}`` and the like stand for the source table. A clip is
fifteen users, a body is a user, and a frame is the place of an event among its user's events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FPS = 12
GRAVITY = 9.81

TRAJ = f"""
select clip_uid, body_id, frame, px, py, pz,
    case when frame = 0 then 0e0 else (px - qpx) * {FPS}e0 end as vx, case when frame = 0 then 0e0 else (py - qpy) * {FPS}e0 end as vy, case when frame = 0 then 0e0 else (pz - qpz) * {FPS}e0 end as vz,
    wx, wy, wz, qw, qx, qy, qz, present, sx, sy, sz, cr, cg, cb, opacity, 0.5e0 as radius, cast(1 + body_id % 5 as double) as mass,
    case when body_id % 3 = 0 then 'sphere' when body_id % 3 = 1 then 'cube' else 'cylinder' end as kind
from (select *, lag(px) over (partition by body_id order by frame) as qpx, lag(py) over (partition by body_id order by frame) as qpy, lag(pz) over (partition by body_id order by frame) as qpz
    from (select cast(floor(user_id / 15e0) as bigint) as clip_uid, user_id as body_id, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as int) as frame,
        value / 10e0 as px, (event_id % 97) / 10e0 as py, 1e0 + (event_id % 53) / 10e0 as pz,
        (event_id % 13) / 3e0 - 2e0 as wx, (event_id % 7) / 3e0 - 1e0 as wy, (event_id % 5) / 3e0 as wz,
        1e0 + event_id % 3 as qw, (event_id % 4) * 1e0 as qx, (event_id % 5) * 1e0 as qy, (event_id % 2) * 1e0 as qz,
        event_type <> 'error' as present, 1e0 + (event_id % 7) / 20e0 as sx, 1e0 + (event_id % 3) / 20e0 as sy, 1e0 + (event_id % 11) / 20e0 as sz,
        (event_id % 11) / 10e0 as cr, (event_id % 9) / 8e0 as cg, (event_id % 6) / 5e0 as cb, 1e0 - (event_id % 5) / 10e0 as opacity
    from {{events}}) as numbered) as lagged
"""

#: Impulses reported at some frames between a body and its neighbour in the clip.
CONTACTS = """
select cast(floor(user_id / 15e0) as bigint) as clip_uid, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as int) as frame, event_id as seq,
    user_id as body_a, user_id + 1 as body_b, 0e0 as nx, 0.6e0 as ny, 0.8e0 as nz, value / 10e0 as impulse
from {events}
"""

#: What the plan of each clip says of its bodies; bodies of a clip stand in a ring of fifteen.
PLANS = """
select distinct cast(floor(user_id / 15e0) as bigint) as clip_uid, user_id as body_id, 1e0 + cast(floor(user_id / 15e0) as bigint) % 4 / 2e0 as surface_top,
    case when user_id % 5 <> 0 then 3e0 + user_id % 3 end as cx, 5e0 as cy, 2e0 as hx, 1e0 + user_id % 2 * 2e0 as hy,
    case when user_id % 4 = 0 then null when user_id % 15 = 14 then user_id - 14 else user_id + 1 end as partner_id, user_id % 3 = 1 as pass_through,
    (user_id % 2) * 1e0 as contact_nx, (user_id % 3) * 0.5e0 as contact_ny, (user_id % 5) * 1e0 as contact_nz, case when user_id % 7 = 0 then 1.25e0 end as partner_extent,
    case when user_id % 3 <> 0 then user_id - user_id % 15 + (user_id % 15 + 4) % 15 end as pair_to, user_id - user_id % 15 + (user_id % 15 + 2) % 15 as sibling, user_id % 5 = 4 as single,
    case when user_id % 2 = 0 then 3 + user_id % 5 end as flight_from, case when user_id % 11 = 0 then 4 + user_id % 5 else 18 + user_id % 9 end as flight_to,
    case when user_id % 2 = 1 then 4e0 + user_id % 3 end as pivot_x, 5e0 as pivot_y, 8e0 as pivot_z, case when user_id % 6 = 1 then 1.5e0 end as arm,
    case when user_id % 3 = 0 then 6e0 + user_id % 5 else 0e0 end as v_ref, case when user_id % 13 <> 0 then user_id - user_id % 15 + (user_id % 15 + 14) % 15 end as caster_id,
    (user_id % 4) / 10e0 as lx, 0.2e0 as ly, case when user_id % 9 = 8 then 0e0 else -1e0 - user_id % 2 end as lz
from {events}
"""

#: How bodies are declared: body 0 of a clip is its floor, 9 and 10 are static boxes, one of them turned in odd clips, 12 sleeps.
BODIES = """
select clip_uid, body_id, body_id % 15 as ord, body_id % 15 in (0, 9, 10) as static, body_id % 15 = 0 as floor, body_id % 15 = 12 as dormant, body_id % 15 in (0, 4, 9, 10) as box,
    px as x0, py as y0, pz as z0, case when body_id % 15 = 0 then 20e0 else 1.5e0 end as hx, case when body_id % 15 = 0 then 20e0 when body_id % 15 = 9 then 0.4e0 else 1e0 end as hy,
    case when body_id % 15 = 0 then 0.1e0 when body_id % 15 in (9, 10) then 2e0 else 0.5e0 end as hz, case when body_id % 15 = 10 and clip_uid % 2 = 1 then 0.9e0 else 1e0 end as q0, radius
from {traj} as placed where frame = 0
"""

#: A clip is a thousand orders, so clips grow with the table. The culprit, body 1, is hidden on the invalid side in every fifth frame, and
#: both sides agree in every third; where two rows meet in a pixel, the least body and the largest channels stay.
CELLS = """
select clip_uid, frame, y, x, min(body_id) filter (where on_v) as body_v, max(r) filter (where on_v) as r_v, max(g) filter (where on_v) as g_v, max(b) filter (where on_v) as b_v,
    min(body_id) filter (where on_i) as body_i, max(r) filter (where on_i) as r_i, max(g) filter (where on_i) as g_i, max(b) filter (where on_i) as b_i
from (select *, case when frame % 3 = 0 then on_v else not on_v and not (body_id = 1 and frame % 5 = 1) end as on_i
    from (select cast(floor(l_orderkey / 1000e0) as bigint) as clip_uid, cast(l_partkey % 25 as int) as frame, cast(l_suppkey % 16 as int) as y, cast(l_orderkey % 16 as int) as x, cast(1 + l_linenumber % 3 as bigint) as body_id,
        cast(l_partkey * 7 % 256 as int) as r, cast(l_suppkey * 5 % 256 as int) as g, cast(l_orderkey * 3 % 256 as int) as b, l_linestatus = 'F' as on_v from {lineitem}) as placed) as shown
where on_v or on_i group by clip_uid, frame, y, x
"""

#: What the plan of each pair of clips says, over ``{clips}`` (clip_uid): windows, culprits and static bodies as pixels show them.
PAIR_PLANS = """
select clip_uid, 25 as frames, clip_uid % 23 as family_no, cast(5 + clip_uid % 7 as int) as t_event, case when clip_uid % 3 = 0 then 0.8e0 when clip_uid % 3 = 1 then 0e0 end as r_strong,
    cast(5 + clip_uid % 7 as int) as v1, cast(case when clip_uid % 4 = 0 then 8 + clip_uid % 7 else 20 end as int) as v2, cast(case when clip_uid % 4 = 0 then 13 + clip_uid % 7 end as int) as v3, cast(case when clip_uid % 4 = 0 then 15 + clip_uid % 7 end as int) as v4,
    cast(case when clip_uid % 5 <> 0 then 5 + clip_uid % 7 end as int) as i1, cast(case when clip_uid % 5 <> 0 then 7 + clip_uid % 7 end as int) as i2,
    cast(case when clip_uid % 6 <> 0 then 6 + clip_uid % 7 end as int) as c1, cast(case when clip_uid % 6 <> 0 then 16 + clip_uid % 9 end as int) as c2
from {clips}
"""

CLIPS = """
select o_orderkey as clip_key, concat('rel/', replace(substring(o_orderpriority, 3, 20), ' ', '_'), '/', cast(o_custkey as varchar(20))) as pair_uid,
    concat('rel/', replace(substring(o_orderpriority, 3, 20), ' ', '_'), '/', cast(o_custkey as varchar(20)), '/', cast(o_orderkey as varchar(20))) as clip_uid,
    case when o_orderstatus = 'F' then 'valid' else 'invalid' end as label, case when o_orderkey % 3 = 0 then 'weak' when o_orderkey % 3 = 1 then 'medium' else 'strong' end as severity_bin,
    o_totalprice as magnitude, substring(o_orderpriority, 3, 20) as scenario, o_orderkey % 23 as family_no, o_orderkey % 7 = 0 as moving, o_orderkey
from {orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def traj(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TRAJ, events=table(spark, sf_dir, "events"))


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh event is a contact."""
    return spark.sql(CONTACTS, events=table(spark, sf_dir, "events")).where("seq % 7 = 0")


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PLANS, events=table(spark, sf_dir, "events"))


def bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BODIES, traj=traj(spark, sf_dir))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of every pixel place, dealt by clip: what is grouped or joined by clip and frame afterwards stays where it is."""
    rows = table(spark, sf_dir, "lineitem").withColumn("deal", F.floor(F.col("l_orderkey") / 1000.0).cast("long")).repartition("deal")
    return spark.sql(CELLS.replace("cast(floor(l_orderkey / 1000e0) as bigint) as clip_uid", "deal as clip_uid"), lineitem=rows)


def cell_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clips of ``cells``, without making their cells."""
    shown = CELLS[CELLS.index("from (select *, case") : CELLS.index("group by clip_uid")]
    return spark.sql(f"select distinct clip_uid {shown}", lineitem=table(spark, sf_dir, "lineitem"))


def pair_plans(clips: DataFrame) -> DataFrame:
    """``PAIR_PLANS`` of the clips with the kind and reference of their family, as plans of ``operators.annotate``."""
    from lawtrace.operators import taxonomy

    spark = clips.sparkSession
    window = lambda *ends: F.array_compact(F.array(*[F.when(F.col(s).isNotNull(), F.struct(F.col(s).alias("s"), F.col(e).alias("e"))) for s, e in ends]))
    families = taxonomy.families(spark).select(F.col("family_no").cast("long").alias("family_no"), "family", "detectable", "strong")
    p = spark.sql(PAIR_PLANS, clips=clips).join(F.broadcast(families), "family_no")  # 23 rows
    ids = lambda *x: F.array(*[F.lit(i).cast("long") for i in x]).cast("array<long>")
    return p.select(
        "clip_uid", "frames", "family", "detectable", "strong", "r_strong", "t_event", window(("v1", "v2"), ("v3", "v4")).alias("violation_windows"), F.when(F.col("i1").isNotNull(), window(("i1", "i2"))).alias("intervention_windows"),
        F.when(F.col("c1").isNotNull(), window(("c1", "c2"))).alias("consequence_windows"), ids(1).alias("culprits"), F.lit(1).cast("long").alias("primary"), ids(3).alias("static_ids"), F.when(F.col("clip_uid") % 2 == 0, ids(2)).otherwise(ids()).alias("moved"),
    )


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CLIPS, orders=table(spark, sf_dir, "orders"))


def sql_with(*names: str) -> str:
    """A WITH clause that defines the named views for DuckDB."""
    texts = {"traj": TRAJ.format(events="events"), "contacts": f"select * from ({CONTACTS.format(events='events')}) as c where seq % 7 = 0", "plans": PLANS.format(events="events"), "bodies": BODIES.format(traj="traj"), "cells": CELLS.format(lineitem="lineitem"), "clips": CLIPS.format(orders="orders")}
    return "with " + ", ".join(f"{n} as ({texts[n]})" for n in names)
