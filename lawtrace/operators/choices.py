"""Choosing what a plan acts on, when, and how results are laid out: participants, members, moving variants, frames and severity columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lawtrace.operators.edits import draw, share_size
from lawtrace.operators.intervals import longest_run

BODY = ["clip_uid", "body_id"]
SEVERITIES = ("valid", "weak", "medium", "strong")
PERIOD = 5  # one variant of so many has a moving camera, the last of each block


def participants(plans: DataFrame, bodies: DataFrame) -> DataFrame:
    """``plans`` (clip_uid, causal array of body ids) with dynamic_ids and static_ids, both in the plan's own order, and primary: the first dynamic one, else
    the first. bodies: (clip_uid, body_id, static); ids that name no body count as static."""
    moving = bodies.where("not static").groupBy("clip_uid").agg(F.collect_set("body_id").alias("moving"))
    t = plans.join(moving, "clip_uid", "left").withColumn("moving", F.coalesce("moving", F.array().cast("array<long>")))
    moves = lambda i: F.array_contains("moving", i)
    t = t.withColumns({"dynamic_ids": F.filter("causal", moves), "static_ids": F.filter("causal", lambda i: ~moves(i))})
    return t.withColumn("primary", F.coalesce(F.get("dynamic_ids", F.lit(0)), F.get("causal", F.lit(0)))).drop("moving")


def members(bodies: DataFrame, declared: DataFrame | None = None, salt: str = "members") -> DataFrame:
    """``(clip_uid, body_id, ord, chosen_by)``: the bodies that an edit acts on.

    bodies: (clip_uid, body_id, ord, actor, dormant, fraction). Bodies that the scene declares (clip_uid, body_id, ord) are taken, in the declared order.
    Otherwise it is a share of the live actors where there are four or more and the scene gives a fraction, drawn by key, so that it is the
    same at every severity; else the first live actor. Dormant bodies are never drawn.
    """
    live = bodies.where("actor and not dormant")
    if declared is not None:
        named = declared.join(bodies.select(*BODY), BODY, "left_semi")
        live = live.join(named.select("clip_uid").distinct(), "clip_uid", "left_anti")
    of = Window.partitionBy("clip_uid")
    t = live.withColumns({"n": F.count("*").over(of), "u": draw(F.col("clip_uid"), F.col("body_id"), salt=salt)})
    grouped = (F.coalesce("fraction", F.lit(0.0)) > 0) & (F.col("n") >= 4)
    k = F.when(grouped, F.least(share_size(F.col("n"), F.col("fraction")), F.col("n"))).otherwise(1)
    place = F.row_number().over(of.orderBy(F.when(grouped, F.col("u")), "ord"))
    drawn = t.withColumns({"k": k, "place": place, "chosen_by": F.when(grouped, "share").otherwise("first")}).where("place <= k").select(*BODY, "ord", "chosen_by")
    return drawn if declared is None else drawn.unionByName(named.select(*BODY, "ord", F.lit("declared").alias("chosen_by")))


def camera_moves(variant: Column, level_moves: Column, scene_moves: Column) -> Column:
    """Whether a variant's camera moves: the last variant of each block of ``PERIOD``, the same in every scenario, where level and scene allow it."""
    return level_moves & scene_moves & (F.pmod(variant, F.lit(PERIOD)) == PERIOD - 1)


def frame_in_band(low: Column, high: Column, unit: Column) -> Column:
    """A frame of the band by a number in [0, 1), half to even; its lower end if the band is empty."""
    return F.when(high <= low, low).otherwise(low + F.bround(unit * (high - low)).cast("int"))


def contact_free_runs(frames: DataFrame, touching: DataFrame, least: int = 2) -> DataFrame:
    """``(clip_uid, body_id, s, e)``: the longest run of frames without a contact at them or next to them, the first of equals.

    frames: (clip_uid, body_id, frame), dense; touching: (clip_uid, body_id, frame). Runs shorter than ``least`` do not count."""
    near = touching.select(*BODY, F.explode(F.sequence(F.col("frame") - 1, F.col("frame") + 1)).alias("frame")).distinct().withColumn("touch", F.lit(True))
    t = frames.join(near, [*BODY, "frame"], "left").withColumn("free", F.col("touch").isNull())
    return longest_run(t, BODY, "free", least).select(*BODY, "s", "e")


def acting_frames(wanted: DataFrame, runs: DataFrame, share: float = 0.4, floor: float = 1 / 6) -> DataFrame:
    """``wanted`` (clip_uid, body_id, frames, want, unit) with ``frame``: when to act on a body so that the violation has room.

    Inside the body's contact-free run, with ``share`` of it still ahead and after ``floor`` of the clip, at least one frame into the run: ``want``
    where it lies there, else placed in that band by ``unit``. A frame outside 1 to T - 2, and a body without a run, keeps ``want``.
    """
    t = wanted.join(runs, BODY, "left")
    latest = F.col("e") - F.bround(share * (F.col("e") - F.col("s"))).cast("int")
    earliest = F.greatest(F.col("s") + 1, F.lit(1), F.bround(F.lit(floor) * F.col("frames")).cast("int"))
    placed = F.when((F.col("want") >= earliest) & (F.col("want") <= latest), F.col("want")).otherwise(frame_in_band(earliest, F.greatest(earliest, latest), F.col("unit")))
    fits = F.col("s").isNotNull() & (placed >= 1) & (placed < F.col("frames") - 1)
    return t.withColumn("frame", F.when(fits, placed).otherwise(F.col("want"))).drop("s", "e")


def severity_rank(name: Column) -> Column:
    """Place among valid, weak, medium and strong; others after them."""
    out = F.lit(len(SEVERITIES))
    for i in range(len(SEVERITIES) - 1, -1, -1):
        out = F.when(name == SEVERITIES[i], i).otherwise(out)
    return out


def comparison(clips: DataFrame) -> DataFrame:
    """A row for each (pair_uid, family) with its clips in the order of severity: names, in one list, and the clip of each column, null where missing.

    clips: (pair_uid, family, clip_uid, severity); the last uid stands where a severity has several."""
    t = clips.withColumn("rank", severity_rank(F.col("severity")))
    columns = [F.max(F.when(F.col("rank") == i, F.col("clip_uid"))).alias(n) for i, n in enumerate(SEVERITIES)]
    order = F.transform(F.array_sort(F.collect_set(F.struct("rank", "severity"))), lambda s: s["severity"])
    return t.groupBy("pair_uid", "family").agg(order.alias("shown"), *columns)


def selected(clips: DataFrame, scenarios: list[str] | None = None, families: list[str] | None = None, severities: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Clips of the named scenarios, families and severities (all, where none are named), the first ``limit`` by uid: filters reach the scan, and the limit is a top-k."""
    out = clips
    for column, names in (("scenario", scenarios), ("family", families), ("severity_bin", severities)):
        if names:
            out = out.where(F.col(column).isin(*names))
    return out if limit is None else out.orderBy("clip_uid").limit(limit)
