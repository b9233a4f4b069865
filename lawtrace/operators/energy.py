"""Mechanical energy of bodies and scenes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawtrace.functions.vectors import dot, inertia, vec, world_to_body


def by_frame():
    return Window.partitionBy("clip_uid", "body_id").orderBy("frame")


def by_clip():
    return Window.partitionBy("clip_uid").orderBy("frame")


def by_body(traj: DataFrame, gravity: float = 9.81, datum: float = 0.0, half_extent: float = 0.5) -> DataFrame:
    """Rows with mass, momentum, body-frame angular momentum, speed, height, kinetic, potential and energy.

    Mass follows the volume of the scale, inertia mass times squared scale; absent bodies have none of it.
    """
    here = F.col("present").cast("double")
    m = F.col("mass") * F.greatest(F.col("sx") * F.col("sy") * F.col("sz"), F.lit(1e-9))
    i0 = inertia(F.col("kind"), (F.lit(half_extent),) * 3)
    moments = [m * i * s * s for i, s in zip(i0, vec("s"))]
    w = world_to_body(vec("q", "wxyz"), vec("w"))
    t = traj.withColumns({"m": m, **{f"j{a}": j for a, j in zip("xyz", moments)}, **{f"o{a}": o for a, o in zip("xyz", w)}})
    kinetic = 0.5 * F.col("m") * dot(vec("v"), vec("v"))
    turning = 0.5 * sum(F.col(f"j{a}") * F.col(f"o{a}") * F.col(f"o{a}") for a in "xyz")
    t = t.withColumns({"height": F.col("pz") - datum, "speed": F.sqrt(dot(vec("v"), vec("v"))), "kinetic_t": kinetic * here, "kinetic_r": turning * here, "potential": F.col("m") * gravity * (F.col("pz") - datum) * here})
    t = t.withColumns({**{f"mom{a}": F.col("m") * F.col(f"v{a}") * here for a in "xyz"}, **{f"ang{a}": F.col(f"j{a}") * F.col(f"o{a}") * here for a in "xyz"}})
    return t.withColumn("kinetic", F.col("kinetic_t") + F.col("kinetic_r")).withColumn("energy", F.col("kinetic") + F.col("potential"))


def trace(bodies: DataFrame, contacts: DataFrame, in_frame: Column | None = None, slack: int = 1) -> DataFrame:
    """Per (clip, frame): total energy, what left it, and three anomalies as shares of the clip's first energy.

    Energy that moves off contact, that appears at contact, and that is lost beyond what bodies had to give. Contact
    frames are widened by ``slack`` without wrapping. One window per body, one aggregation, one window per clip.
    """
    lag = lambda c: F.coalesce(F.lag(c).over(by_frame()), F.col(c))
    change = F.col("energy") - lag("energy")
    released = F.greatest(lag("potential") - F.col("potential"), F.lit(0.0))
    budget = lag("kinetic") + F.when(lag("present") & F.col("present"), released).otherwise(0.0)
    seen = F.coalesce(in_frame, F.lit(True)) if in_frame is not None else F.lit(True)
    b = bodies.withColumn("excess", F.greatest(-change - budget, F.lit(0.0))).withColumn("seen", seen & F.col("present"))
    scene = b.groupBy("clip_uid", "frame").agg(F.sum("energy").alias("total"), F.sum("kinetic_t").alias("kinetic_t"), F.sum("kinetic_r").alias("kinetic_r"), F.sum("potential").alias("potential"), F.sum(F.when(F.col("seen"), F.col("energy")).otherwise(0.0)).alias("total_in_frame"), F.sum("excess").alias("excess"), F.min("seen").alias("all_seen"))
    touched = contacts.select("clip_uid", "frame").distinct().withColumn("touch", F.lit(True))
    t = scene.join(touched, ["clip_uid", "frame"], "left")
    near = F.coalesce(F.max("touch").over(by_clip().rangeBetween(-slack, slack)), F.lit(False))
    first = F.first_value("total").over(by_clip())
    step = F.coalesce(F.col("total") - F.lag("total").over(by_clip()), F.lit(0.0))
    t = t.withColumns({"near": near, "first": first, "step": step}).withColumn("scale", F.greatest(F.abs("first"), F.lit(1e-9)))
    return t.select("clip_uid", "frame", "total", "kinetic_t", "kinetic_r", "potential", "total_in_frame", "all_seen", (F.col("first") - F.col("total")).alias("dissipated"), F.when(F.col("near"), 0.0).otherwise(F.abs("step") / F.col("scale")).alias("free_anomaly"), F.when(F.col("near"), F.greatest("step", F.lit(0.0)) / F.col("scale")).otherwise(0.0).alias("contact_anomaly"), (F.col("excess") / F.col("scale")).alias("excess_loss"))


def summary(traced: DataFrame) -> DataFrame:
    """One row for each clip."""
    ends = traced.groupBy("clip_uid").agg(F.min_by("total", "frame").alias("first"), F.max_by("total", "frame").alias("last"), *[F.max(c).alias(f"peak_{c}") for c in ("free_anomaly", "contact_anomaly", "excess_loss")], F.count_if("all_seen").alias("frames_all_seen"))
    return ends.withColumn("dissipated", F.col("first") - F.col("last")).withColumn("fraction", F.col("dissipated") / F.greatest(F.abs("first"), F.lit(1e-9)))


def free_anomaly(bodies: DataFrame, contacts: DataFrame, last: Column, slack: int = 1) -> DataFrame:
    """Each body's own change of energy on frames without an own contact, as a share of the clip's first energy.

    A contact also covers the frame before and after it, where the clip's end joins its start.
    """
    from lawtrace.operators.intervals import widened_round

    own = contacts.select("clip_uid", "frame", F.explode(F.array("body_a", "body_b")).alias("body_id")).distinct().withColumn("touch", F.lit(True))
    t = bodies.join(own, ["clip_uid", "body_id", "frame"], "left").withColumn("touch", F.coalesce("touch", F.lit(False)))
    change = F.coalesce(F.col("energy") - F.lag("energy").over(by_frame()), F.lit(0.0))
    start = bodies.where("frame = 0").groupBy("clip_uid").agg(F.greatest(F.abs(F.sum("energy")), F.lit(1e-9)).alias("scale"))
    t = t.withColumns({"change": F.abs(change), "near": widened_round(F.col("touch"), ["clip_uid", "body_id"], slack, last)})
    return t.join(start, "clip_uid").select("clip_uid", "body_id", "frame", F.when(F.col("near"), 0.0).otherwise(F.col("change") / F.col("scale")).alias("r"))
