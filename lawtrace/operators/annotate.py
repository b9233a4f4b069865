"""Labels of whole pairs: timelines, masks, fields and grids of both twins, all keyed by clip.

A cell is one pixel place of a pair, (clip_uid, frame, y, x), with what either side shows there: ``body_v, r_v, g_v, b_v`` and
``body_i, r_i, g_i, b_i``, null where it shows background. Cells dealt by clip once serve every aggregation, window and join here
without another exchange of pixels. A plan is one row for each clip: see ``PLAN``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lawtrace.operators.intervals import attributed, within
from lawtrace.operators.pixels import FRAME, PIXEL, dilated

#: Columns of a plan. Windows are arrays of (s, e), null where the plan says nothing; bodies are ids as pixels show them.
PLAN = ("clip_uid", "frames", "detectable", "strong", "r_strong", "t_event", "violation_windows", "intervention_windows", "consequence_windows", "culprits", "primary", "static_ids", "moved")
LEVEL, LEAST = 8, 4  # a changed pixel, and how many of them show a change inside an unchanged footprint


def interventions() -> Column:
    return F.coalesce("intervention_windows", "violation_windows")


def consequences() -> Column:
    return F.coalesce("consequence_windows", "violation_windows")


def scored_windows() -> Column:
    """Where a family can be seen: an event while it is made, a state while it lasts."""
    return F.when(F.col("detectable") == "event", interventions()).otherwise(consequences())


def strong_residual() -> Column:
    """The plan's own measured reference; the family's where the plan has none or zero."""
    return F.coalesce(F.nullif(F.col("r_strong"), F.lit(0.0)), F.col("strong"))


def compared(cells: DataFrame, plans: DataFrame) -> DataFrame:
    """``cells`` with in_v and in_i, whether a culprit has the pixel on either side, and the largest difference of a channel."""
    own = lambda s: F.coalesce(F.array_contains("culprits", F.col(f"body_{s}")), F.lit(False))
    off = F.greatest(*[F.abs(F.coalesce(f"{c}_v", F.lit(0)) - F.coalesce(f"{c}_i", F.lit(0))) for c in "rgb"])
    return cells.join(plans.select("clip_uid", "culprits", "primary"), "clip_uid").withColumns({"in_v": own("v"), "in_i": own("i"), "off": off})


def _by_frame(rows: DataFrame, name: str) -> DataFrame:
    """Rows (clip_uid, frame, ..) as one map for each clip, from frame to the rest: what joins by clip alone needs no other exchange than by clip."""
    rest = [c for c in rows.columns if c not in FRAME]
    return rows.groupBy("clip_uid").agg(F.map_from_entries(F.collect_list(F.struct("frame", F.struct(*rest)))).alias(name))


def timeline(pairs: DataFrame, plans: DataFrame, motion: DataFrame) -> DataFrame:
    """Every frame of every plan with its named gates; pairs are those of ``compared``.

    motion: (clip_uid, frame, score, diverged, absent): the bounded score of the primary culprit, whether a culprit or a disturbed
    body has left its lawful path, and whether a culprit is absent on the invalid side; a missing row is 0 and false.

    active, intervening and consequence raster the plan's windows, and scored those of the family's kind. observable: the twins
    disagree about a culprit. seen_invalid: the invalid side shows one. visible with s_visible places the scores of scored frames where
    the twins show them, visible_inv with s_inv where the invalid side does; seen is either. causal: what follows from the violation
    and shows. gone: a visible frame whose culprit is absent and has no pixel. occluded_v and occluded_i: the primary has none.
    """
    changed = (F.col("body_v").isNotNull() & F.col("body_i").isNotNull() & (F.col("in_v") | F.col("in_i")) & (F.col("off") >= LEVEL)).cast("int")
    shows = lambda s: F.max(F.coalesce(F.col(f"body_{s}") == F.col("primary"), F.lit(False)))
    found = pairs.groupBy(*FRAME).agg((F.max(F.col("in_v") != F.col("in_i")) | (F.sum(changed) >= LEAST)).alias("observable"), F.max("in_i").alias("seen_invalid"), shows("v").alias("shown_v"), shows("i").alias("shown_i"))
    frames = plans.select("clip_uid", "frames", "violation_windows", interventions().alias("iw"), consequences().alias("cw"), scored_windows().alias("sw"))
    t = frames.join(_by_frame(found, "f"), "clip_uid", "left").join(_by_frame(motion, "m"), "clip_uid", "left").withColumn("frame", F.explode(F.sequence(F.lit(0), F.col("frames") - 1)))
    t = t.withColumns({"f": F.try_element_at("f", F.col("frame")), "m": F.try_element_at("m", F.col("frame"))})
    t = t.select(*FRAME, "violation_windows", "iw", "cw", "sw", *[F.col(f"f.{c}") for c in found.columns[2:]], *[F.col(f"m.{c}") for c in ("score", "diverged", "absent")])
    flag = lambda c: F.coalesce(c, F.lit(False))
    t = t.select(
        *FRAME, *[within(F.col(w), F.col("frame")).alias(n) for n, w in (("active", "violation_windows"), ("intervening", "iw"), ("consequence", "cw"), ("scored", "sw"))],
        *[flag(n).alias(n) for n in ("observable", "seen_invalid", "diverged", "absent")], (~flag("shown_v")).alias("occluded_v"), (~flag("shown_i")).alias("occluded_i"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    t = attributed(t, ["clip_uid"], "score", "scored", "observable").withColumnsRenamed({"gate": "visible", "placed": "s_visible"})
    t = attributed(t.withColumn("both", F.col("observable") & F.col("seen_invalid")), ["clip_uid"], "score", "scored", "both").withColumnsRenamed({"gate": "visible_inv", "placed": "s_inv"}).drop("both")
    gone = F.col("visible") & F.col("absent") & ~(F.col("visible_inv") & F.col("seen_invalid"))
    return t.withColumns({"seen": F.col("visible") | F.col("visible_inv"), "causal": (F.col("consequence") | F.col("diverged")) & F.col("observable"), "gone": gone})


def temporal_block(times: DataFrame, plans: DataFrame) -> DataFrame:
    """Per clip: event, end, first observable frame (the event, if none), its lag, whether the primary is hidden at the event, and the last
    frames of interventions and consequences."""
    last = lambda c: F.array_max(F.transform(c, lambda w: w["e"]))
    first = F.array_min(F.transform("violation_windows", lambda w: w["s"]))
    ends = plans.select("clip_uid", first.alias("t_event"), last(F.col("violation_windows")).alias("t_end"), last(interventions()).alias("t_intervention_end"), last(consequences()).alias("t_consequence_end"))
    t = times.join(ends, "clip_uid").groupBy("clip_uid", "t_event", "t_end", "t_intervention_end", "t_consequence_end")
    t = t.agg(F.min(F.when(F.col("observable"), F.col("frame"))).alias("first"), F.max((F.col("frame") == F.col("t_event")) & F.col("occluded_i")).alias("occluded_at_event"))
    t = t.withColumn("t_obs", F.coalesce("first", "t_event"))
    return t.select("clip_uid", "t_event", "t_end", "t_obs", (F.col("t_obs") - F.col("t_event")).alias("lag"), F.coalesce("occluded_at_event", F.lit(False)).alias("occluded_at_event"), "t_intervention_end", "t_consequence_end")


def painted(pairs: DataFrame, times: DataFrame) -> DataFrame:
    """Cells with ``violation``, ``invalid`` and ``reference`` (masks), ``severity`` and ``divergence`` (zero: nothing), and the gates of
    their frame. Severity lies on the invalid side's culprits; only where they are gone and leave no pixel, on the lawful footprint."""
    names = ("seen", "visible_inv", "gone", "causal", "observable", "s_visible", "s_inv")
    gates = times.groupBy("clip_uid").agg(F.array_sort(F.collect_list(F.struct("frame", *names))).alias("gates"))  # one for each frame, from 0
    severity = F.when(F.col("in_i") & F.col("visible_inv"), F.col("s_inv")).when(F.col("in_v") & F.col("gone"), F.col("s_visible")).otherwise(0.0)
    out = pairs.join(gates, "clip_uid").withColumn("gate", F.get("gates", F.col("frame"))).where("gate is not null").drop("gates").withColumns({n: F.col(f"gate.{n}") for n in names}).drop("gate")
    return out.withColumns({"violation": F.col("seen") & (F.col("in_v") | F.col("in_i")), "invalid": F.col("visible_inv") & F.col("in_i"), "reference": F.col("in_v"), "severity": severity, "divergence": F.col("off") / 255.0})


def measured(pixels: DataFrame) -> DataFrame:
    """Per clip with cells: the peak of the severity, the observable frames (each has pixels) and evidence, the largest divergence inside the
    violation mask; ``pixels.measured`` in one pass over ``painted`` cells."""
    frames = pixels.groupBy(*FRAME).agg(F.max(F.when(F.col("invalid"), F.col("severity"))).alias("peak"), F.max("observable").cast("long").alias("observable"), F.max(F.when(F.col("violation"), F.col("divergence"))).alias("evidence"))
    top = lambda c: F.coalesce(F.max(c), F.lit(0.0))
    return frames.groupBy("clip_uid").agg(top("peak").alias("peak_severity"), F.sum("observable").alias("observable_frames"), top("evidence").alias("evidence"))


def causal_levels(pixels: DataFrame, plans: DataFrame, height: int, width: int, k: int = 3) -> DataFrame:
    """Pixels of the invalid side on causal frames: 1 on culprits, 2 on bodies that left their path, and on static bodies that the plan
    names within ``k`` pixels of a culprit."""
    t = pixels.where("causal and body_i is not null").select(*PIXEL, "in_i", "body_i").join(plans.select("clip_uid", "moved", "static_ids"), "clip_uid")
    listed = lambda c: F.array_contains(c, F.col("body_i"))
    beside = t.where(~F.col("in_i") & listed("static_ids")).join(dilated(t.where("in_i"), k, height, width), PIXEL, "left_semi")
    own = t.where(F.col("in_i") | (listed("moved") & ~listed("static_ids")))
    return own.select(*PIXEL, F.when(F.col("in_i"), 1).otherwise(2).alias("level")).unionByName(beside.select(*PIXEL, F.lit(2).alias("level")))


def token_grid(pixels: DataFrame, frames: int, height: int, width: int, side: int) -> DataFrame:
    """``pixels.token_grid`` of the violation mask and the severity, from their common rows."""
    if frames % 4 != 1 or height % side or width % side:
        raise ValueError(f"{frames} frames of {height} x {width} do not divide into 4k + 1 frames and {side} x {side} blocks")
    bh, bw = height // side, width // side
    cell = [F.ceil(F.col("frame") / 4).cast("int").alias("f_lat"), F.floor(F.col("y") / bh).cast("int").alias("h_lat"), F.floor(F.col("x") / bw).cast("int").alias("w_lat")]
    volume = F.when(F.col("f_lat") == 0, 1).otherwise(4) * (bh * bw)
    out = pixels.where("violation or severity <> 0").select("clip_uid", *cell, "violation", "severity").groupBy("clip_uid", "f_lat", "h_lat", "w_lat")
    return out.agg(F.max("violation").alias("hit"), F.max("severity").alias("peak"), F.sum("severity").alias("s")).withColumn("mean", F.col("s") / volume).drop("s")


def annotations(pixels: DataFrame, levels: DataFrame, energies: DataFrame | None = None) -> DataFrame:
    """One row for each pixel of each annotation of each side: (side, annotation, clip_uid, frame, y, x, value).

    Both sides have their segmentation, the reference mask and, if ``energies`` (clip_uid, side, frame, body_id, share) are given, the
    energy map; only the invalid side has what says what is wrong. The annotations of a cell are one list, so cells are read once.
    """
    def row(side: str, annotation: str, value: Column, where: Column) -> Column:
        return F.when(where, F.struct(F.lit(side).alias("side"), F.lit(annotation).alias("annotation"), value.cast("double").alias("value")))

    one = F.lit(1.0)
    rows = [row(side, "seg", F.col(f"body_{side[0]}"), F.col(f"body_{side[0]}").isNotNull()) for side in ("valid", "invalid")]
    rows += [row(side, "reference_mask", one, F.col("reference")) for side in ("valid", "invalid")]
    rows += [row("invalid", "violation_mask", one, F.col("violation")), row("invalid", "mask_invalid", one, F.col("invalid"))]
    rows += [row("invalid", f"{n}_map", F.col(n), F.col(n) != 0) for n in ("severity", "divergence")]
    out = pixels.select(*PIXEL, F.explode(F.array_compact(F.array(*rows))).alias("a")).select("a.side", "a.annotation", *PIXEL, "a.value")
    out = out.unionByName(levels.select(F.lit("invalid").alias("side"), F.lit("causal_mask").alias("annotation"), *PIXEL, F.col("level").cast("double").alias("value")))
    if energies is not None:
        shown = pixels.select(*PIXEL, F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"body_{s[0]}").alias("body_id")) for s in ("valid", "invalid")])).alias("b")).select(*PIXEL, "b.*")
        energy = shown.join(energies, ["clip_uid", "side", "frame", "body_id"]).where("share <> 0")
        out = out.unionByName(energy.select("side", F.lit("energy_map").alias("annotation"), *PIXEL, F.col("share").cast("double").alias("value")))
    return out


def annotate_pairs(cells: DataFrame, plans: DataFrame, motion: DataFrame, height: int, width: int, energies: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """All labels of the clips that have a plan: ``annotations`` of their pixels, and their ``timeline``. Cells are dealt by clip once.

    Compared cells and the timeline are kept, on disk where memory is short (``unpersist`` lets them go): the timeline and every annotation read
    the cells, every annotation of pixels reads the timeline, and a lost part is made anew."""
    pairs = compared(cells.repartition("clip_uid"), plans).persist()
    times = timeline(pairs, plans, motion).persist()
    pixels = painted(pairs, times)
    return annotations(pixels, causal_levels(pixels, plans, height, width), energies), times
